"""Reports of consolidations, free text or JSON in no fixed form, read by a small grammar.

A report names files by role: ``role phrase, list of references``.  A reference counts only inside such a list;
dates, times, durations, sizes, counts and the like are taken out first, so a stray number is never a file.  A
report that says nothing that can be tied to a role is unread: it kills no file and is listed for people to look at.
Where a report doesn't say clearly that its batch succeeded, it didn't: then the inputs stay valid and nothing is lost.
"""

from __future__ import annotations

import json
import re

#: How a batch ended, in words.
GOOD = frozenset("success successful successfully succeeded succeed committed commit done complete completed ok okay finished published passed".split())
BAD = frozenset("failed failure fail fails failing aborted abort crashed crash error errored errors cancelled canceled killed timeout incomplete unsuccessful partial partially interrupted broken lost running pending started".split())
#: Words of JSON keys by role; a key with a word of NO_FILES holds figures, not files.
INPUT_WORDS = frozenset("in input inputs from source sources src merged members parts files".split())
OUTPUT_WORDS = frozenset("out output outputs to into target dest destination".split())
NO_FILES = frozenset("count counts n num number size sizes bytes records rows duration seconds ms at time ts timestamp date retries retry attempt attempts version lane errors error warnings warning notes note message log host worker took elapsed checksum hash".split())
STATE_WORDS = frozenset("status state outcome end ended phase success succeeded ok committed failed result".split())
REFERENCE_KEYS = ("file_id", "id", "file_path", "path", "file", "name")

_PATH = r"[\w.\-]+(?:/[\w.\-]+)+"
_UUID = r"[0-9a-f]{32}|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"
_BATCH = re.compile(rf"(?<![\w/]){_UUID}(?![\w/])".replace(_UUID, f"(?:{_UUID})"), re.I)
_ROLLBACK = re.compile(r"roll(?:ed|ing)?[\s_-]*back|withdrawn|reverted|undone", re.I)
_NOISE = re.compile(
    rf"(?<![\w/])\d{{1,2}}/\d{{1,2}}/\d{{2,4}}(?![\w/])|({_PATH})|"  # dates with slashes; paths stay as they are
    r"\d{4}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?|\b\d{1,2}[./]\d{1,2}[./]\d{2,4}\b|\b\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\b"  # dates and times
    r"|\b\d+(?:[.,]\d+)?\s*(?:%|percent\b|ms\b|msec\b|s\b|secs?\b|seconds?\b|m\b|mins?\b|minutes?\b|h\b|hrs?\b|hours?\b|d\b|days?\b|[kmgt]i?b\b|b\b|bytes?\b)"  # durations, sizes
    r"|(?<![-–.;|\w])\d+\s+(?:(?!(?:on|in|at|by|to|into|from|after|and|with|is)\b)\w+\s+)?(?:files?|inputs?|outputs?|parts?|records?|rows?|retries|retry|attempts?|tries|warnings?|errors?|failures?|times|tasks?|workers?|stages?|executors?|lanes?)\b(?!\s*[:=])"  # counts
    r"|\b(?:attempt|retry|try|run|worker|host|node|lane|step|line|stage|task|executor|pid|port|exit(?:\s+code)?|code|version|day|week|took|after|within|for)\s*[#=:]?\s*v?\d+(?:\.\d+)*\b",  # numbered things that are no files
    re.I,
)
_ITEM = rf"(?:{_PATH}|\d+(?:\s*(?:-|–|\.\.)\s*\d+)?)"
#: Inside brackets blanks separate as well.
_LIST = re.compile(rf"[\[({{]\s*[\"']?{_ITEM}[\"']?(?:[\s,;|&+\"']+{_ITEM}[\"']?)*\s*[\])}}]|[\[({{]?[\"']?{_ITEM}[\"']?(?:\s*(?:,|;|\||&|\+|\band\b|(?<=[\"'])\s)\s*[\"']?{_ITEM}[\"']?)*[\])}}]?", re.I)
_FILLER = r"(?:\s*\b(?:files?|file_ids?|ids?|paths?|numbers?|nos?|the|small|tiny|old|new|following|one|single|a)\b)*\s*[#:=]?\s*[\[({\"']*\s*$"
_OUT = re.compile(r"(?:->|=>|→|\binto\b|\bout(?:put)?s?\b|\bto\b|\btarget\b|\bdest(?:ination)?\b|\bresult(?:ing)?(?:\s+in)?\b|\bas\b)" + _FILLER, re.I)
_IN = re.compile(r"(?:\binputs?\b|\bin\s*[=:]|\bfrom\b|\bsources?\b|\bsrc\b|\bmerg(?:ed?|ing|es)\b|\bconsolidat(?:ed?|ing|es|ion)\b|\bcombin(?:ed?|ing|es)\b|\bcompact(?:ed|ing|s)?\b|\breplac(?:ed?|ing|es)\b|\b(?:merge|merger|consolidation|compaction|union|concatenation)\s+of\b|\bfiles?\b|\b(?:file_)?(?:ids?|paths?)\b)" + _FILLER, re.I)
_SPAN = re.compile(r"(\d+)\s*(?:-|–|\.\.)\s*(\d+)$")
_HARMLESS = re.compile(r"\b(?:no|zero|0|without(?:\s+any)?|not|never|none)\s+(?:\w+\s+)?(?:fail(?:ed|ures?)?|errors?|crash(?:ed|es)?|abort(?:ed)?|timeouts?|lost|problems?)(?:\s+(?:files?|records?|rows?|inputs?|tasks?))?\b", re.I)
_DENIED = re.compile(r"\b(?:not|never|n't|isn't|wasn't)\s+(?:\w+\s+)?(?:" + "|".join(sorted(GOOD)) + r")\b", re.I)


def references(text: str) -> list[str]:
    """The references of one list: paths, numbers, and spans of numbers as ``lo..hi``."""
    out = []
    for item in re.findall(_ITEM, text):
        span = None if "/" in item else _SPAN.match(item)
        out.append(item if "/" in item or not span else f"{int(span[1])}..{int(span[2])}")
    return out


def ending(text: str) -> str | None:
    """good, bad, or None where the text doesn't say; of several words the last counts, a denied good one is bad."""
    plain = _DENIED.sub(" failed ", _HARMLESS.sub(" ", text))
    said = [w for w in re.findall(r"[a-z]+", plain.lower()) if w in GOOD or w in BAD]
    return None if not said else "good" if said[-1] in GOOD else "bad"


def _key_words(key: object) -> set[str]:
    return set(re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", str(key)).lower()))


def _json_refs(value: object) -> list[str]:
    if isinstance(value, bool) or value is None or isinstance(value, float):
        return []
    if isinstance(value, int):
        return [str(value)]
    if isinstance(value, list):
        return [r for v in value for r in _json_refs(v)]
    if isinstance(value, dict):
        named = next((value[k] for k in REFERENCE_KEYS if k in value), None)
        if named is not None:
            return _json_refs(named)
        return [r for k, v in value.items() if not _key_words(k) & NO_FILES for r in _json_refs(v)]
    text = str(value).strip()
    m = _LIST.fullmatch(text)
    return references(text) if m else []


def _from_json(value: object) -> tuple[list[str], list[str], str | None]:
    ins, outs, states = [], [], []

    def walk(x: object) -> None:
        if isinstance(x, list):
            for v in x:
                walk(v)
        for k, v in x.items() if isinstance(x, dict) else ():
            words = _key_words(k)
            figures = bool(words & NO_FILES)
            if words & STATE_WORDS and isinstance(v, (str, bool)):
                good = ending(v) if isinstance(v, str) and v.strip().lower() not in ("true", "false", "yes", "no") else ("good" if str(v).strip().lower() in ("true", "yes") else "bad")
                if words & BAD and good:  # "failed": false
                    good = "bad" if good == "good" else "good"
                states.append(good)
            elif not figures and words & OUTPUT_WORDS and (r := _json_refs(v)):
                outs.extend(r)
            elif not figures and words & INPUT_WORDS and not (isinstance(v, dict) and any(_key_words(n) & (INPUT_WORDS | OUTPUT_WORDS) for n in v)) and (r := _json_refs(v)):
                ins.extend(r)
            elif isinstance(v, (dict, list)) and not figures:
                walk(v)

    walk(value)
    known = [s for s in states if s]
    return ins, outs, "bad" if "bad" in known else "good" if known else None


def _from_text(text: str) -> tuple[list[str], list[str], str | None]:
    plain = _NOISE.sub(lambda m: m[1] or " files " if m[1] or re.search(r"(?:files?|inputs?|parts?)$", m.group(), re.I) else " ", _BATCH.sub(" ", text))
    ins, outs, at = [], [], 0
    for m in _LIST.finditer(plain):
        before = plain[at : m.start() + (m.group()[:1] in "[({\"'")]
        if _OUT.search(before):
            outs += references(m.group())
        elif _IN.search(before):
            ins += references(m.group())
        else:
            continue
        at = m.end()
    return ins, outs, ending(re.sub(_PATH, " ", plain))


def parse_report(text: str | None) -> list[tuple[str, str]]:
    """(role, reference) of one report: role is input, output, end (good or bad), rollback (batch id) or unread (the text).

    Spans of file numbers stay spans (``lo..hi``).  A null or blank text yields nothing; a report that
    doesn't say how it ended ended badly.
    """
    if not text or not text.strip():
        return []
    if _ROLLBACK.search(text):
        found = [("rollback", b.lower()) for b in _BATCH.findall(text)]
        return found or [("unread", text)]
    try:
        value = json.loads(text)
    except ValueError:
        value = None
    ins, outs, end = _from_json(value) if isinstance(value, (dict, list)) else _from_text(text)
    if not ins and not outs:
        return [("unread", text)]
    return [("end", end or "bad"), *(("input", r) for r in dict.fromkeys(ins)), *(("output", r) for r in dict.fromkeys(outs))]
