"""Abusive, hateful or sexual content: a score for every document and rates per source.

Method: Levenshtein automata intersected with a lexicon trie.  Texts are folded (compatibility forms,
accents, look-alike letters, invisible characters, leet, stretched, spaced out and starred letters); each
word that isn't an entry and isn't an ordinary word (one whole token of a public tokenizer) is run through
the trie by the word's automaton, which accepts entries within a distance that grows with the length.
Around each recognised word a context window of its sentence is scored: the classes of the words in it by side
and distance (somebody addressed, a group, oneself, talk about abuse, things instead of people), the words and
ordered pairs of words near each other.  A document's score is the probability of its worst window.  Windows
inside quotation marks are scored apart, so quotation and the author's own abuse can be told from each other.

Weights start from the lexicon's priors and are fitted to the reviewed documents (``fit_weights``): a sample of
at most MAX_LABELLED documents, whatever the corpus, with the error of reviewers in the target.  Without
labels the priors are the model.

Scale: scoring is narrow, one pass, no shuffle but that of the rates (one row per source after a partial
aggregate).  Each worker keeps a bounded memo of words, so an automaton runs once for a distinct word; windows
are scored in numpy for a whole Arrow batch.  The weights are one array of 2**18 numbers, broadcast.
"""

from __future__ import annotations

import base64
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import spread
from . import lexicon, tokens

#: Score (probability) from which a document counts as abusive.
THRESHOLD = 0.5
#: Words of context on either side of a recognised word, in its sentence.
WINDOW = 7
#: Reviewed documents that the weights are fitted to at most; the ones of least hash.
MAX_LABELLED = 20_000
MEMO_WORDS = 300_000
CATEGORIES = ("insult", "threat", "hateful", "sexual")
#: Which category a window's recognised word speaks for.
KINDS = {"threat": "KILL WPN HOME BODY", "hateful": "GRP SLUR THEM OUT BRAIN HATE", "sexual": "SEX BODYSEX"}

_LOOKALIKE = str.maketrans("аАеЕоОрРсСхХуУкКмМтТнНвВіІјЈѕЅԁһɡαεοικνρτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aaeeooppccxxyykkmmttnnbbiijjssdhgaeoiknptuxabezhikmnoptyx")
#: What a sign or digit stands for; 1 may also be an l.
_LEET = str.maketrans("@$!013457€89", "asioieastebg")
_LEET_L = str.maketrans("@$!013457€89", "asioleastebg")
_FOLD = str.maketrans({"ß": "ss", "ł": "l", "Ł": "l", "ø": "o", "æ": "ae", "œ": "oe", "đ": "d", "’": "'", "‘": "'", "ʼ": "'"})
_CJK = r"぀-ヿ㐀-鿿가-힣"
_WORD = re.compile(rf"[{_CJK}ー]+|[^\W_{_CJK}]+(?:['*@$!€·]+(?=[^\W_]|[*@$])[^\W_{_CJK}]*|\*+)*|[@$*]+[^\W_][\w@$*!€]*|[\"“”„«»‟「」『』]|[,;:]|[.!?。！？…\n]+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_][ .\-_·*]){2,}[^\W_](?![^\W_])")
_QUOTES, _ENDS = frozenset('"“”„«»‟「」『』'), frozenset(".!?。！？…\n")
_INVISIBLE = regex.compile(r"[\p{M}\p{Cf}]+")
_STRETCH2, _STRETCH1 = re.compile(r"(.)\1{2,}"), re.compile(r"(.)\1+")

#: Fixed ids of a text's marks; words of the lexicon follow, then hashed words.
PAD, END, QUOTE, MARK, NUMBER = range(5)
HASH_BITS, FEATURE_BITS = 20, 18
_SIDES = {"<": (0,), "<<": (1,), ">": (2,), ">>": (3,), "*": (0, 1, 2, 3)}


def fold(text: str) -> str:
    """Lower case without accents, invisible characters and compatibility forms."""
    if text.isascii():
        return text.lower()
    plain = unicodedata.normalize("NFKC", text).translate(_FOLD)
    return unicodedata.normalize("NFC", _INVISIBLE.sub("", unicodedata.normalize("NFD", plain))).lower()


class Automaton:
    """Levenshtein automaton of a word (adjacent swaps count one), compiled to bit masks.

    Bit i of ``state[e]`` says that the word's first i letters match what was read with e errors; reading a
    letter is a few integer operations whatever the word's length.  ``*`` in the word matches any letter.
    """

    def __init__(self, word: str, most: int) -> None:
        self.most, self.end = most, 1 << len(word)
        self.full = (self.end << 1) - 1
        self.any = sum(1 << i for i, c in enumerate(word) if c == "*")
        self.masks: dict[str, int] = {}
        for i, c in enumerate(word):
            self.masks[c] = self.masks.get(c, self.any) | 1 << i
        self.start = tuple((1 << (e + 1)) - 1 & self.full for e in range(most + 1))

    def mask(self, c: str) -> int:
        return self.masks.get(c, self.any)

    def step(self, state: tuple[int, ...], c: str, above: tuple[int, ...] | None, last: int) -> tuple[int, ...]:
        """The state after ``c``; ``above`` is the state before the letter before it, whose mask is ``last``."""
        m, out, less = self.mask(c), [], 0
        for e, here in enumerate(state):
            new = (here & m) << 1
            if e:
                new |= state[e - 1] | state[e - 1] << 1 | less << 1
                if above is not None:
                    new |= (above[e - 1] & m & (last >> 1)) << 2
            less = new & self.full
            out.append(less)
        return tuple(out)

    def distance(self, state: tuple[int, ...]) -> int | None:
        return next((e for e, s in enumerate(state) if s & self.end), None)


class Trie:
    """Words by letters; ``near`` is its intersection with a word's automaton."""

    def __init__(self, words) -> None:
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def near(self, word: str, most: int) -> tuple[int, str] | None:
        """(distance, word) of the nearest entry within ``most``; ``*`` matches any letter; ties by name."""
        a = Automaton(word, most)
        found: list[tuple[int, str]] = []
        stack = [(self.root, a.start, None, 0)]
        while stack:
            node, state, above, last = stack.pop()
            for c, child in node.items():
                if not c:
                    if (d := a.distance(state)) is not None:
                        found.append((d, child))
                    continue
                new = a.step(state, c, above, last)
                if any(new):
                    stack.append((child, new, state, a.mask(c)))
        return min(found) if found else None

    def prefixes(self, text: str, start: int):
        """Entries that begin at ``start``, longest last."""
        node = self.root
        for i in range(start, len(text)):
            node = node.get(text[i])
            if node is None:
                return
            if "" in node:
                yield node[""]


@lru_cache(maxsize=1)
def ordinary_words(paths: tuple[str, ...] = ()) -> frozenset[str]:
    """Words that are whole tokens of a public tokenizer, folded: ordinary words are no misspellings of others.

    ``paths`` are rank files; by default the tokenizer's own and the one for many languages beside it.
    A file that isn't there adds nothing.
    """
    main = tokens.default_path() if not paths else None
    out: set[str] = set()
    for path in paths or (main, os.path.join(os.path.dirname(main), "byte_bpe_multi_50k.tiktoken")):
        if not os.path.exists(path):
            continue
        with open(path, "rb") as f:
            for line in f:
                word = base64.b64decode(line.split()[0]).decode("utf-8", "ignore")
                if word[:1] == " " and len(word) > 3 and word[1:].isalpha():
                    out.add(fold(word[1:]))
    return frozenset(out)


def _hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & ((1 << HASH_BITS) - 1)


class Reader:
    """Texts to word ids; lexicon, trie and memo of one Python worker."""

    def __init__(self) -> None:
        self.names = list(lexicon.CLASSES)
        self.cls: dict[str, int] = {}
        for number, text in enumerate(lexicon.CLASSES.values(), 1):
            for w in text.split():
                self.cls.setdefault(fold(w), number)
        self.phrases = [(float(line.split()[0]), [fold(w) for w in line.split()[1:]]) for line in lexicon.PHRASES.strip().splitlines()]
        for w in sorted({w for _, p in self.phrases for w in p}):
            self.cls.setdefault(w, 0)
        self.term = len(self.names) + 1  # abuse and pronouns in scripts without blanks
        self.names += ["TERM", "COMMA"]
        cjk = {w: self.term for w in unicodedata.normalize("NFKC", lexicon.CJK).split()}
        cjk |= {w: self.names.index("YOU") + 1 for w in lexicon.CJK_YOU.split()} | {w: self.names.index("GRP") + 1 for w in lexicon.CJK_GROUPS.split()}
        self.cjk = Trie(cjk)
        words = [*self.cls, *[w for w in cjk if w not in self.cls]]
        self.id = {w: MARK + 2 + i for i, w in enumerate(words)}
        self.first_hash = MARK + 2 + len(words)
        self.class_of = np.zeros(self.first_hash, dtype=np.int32)
        for w, i in self.id.items():
            self.class_of[i] = cjk.get(w, self.cls.get(w, 0))
        self.class_of[MARK] = self.names.index("COMMA") + 1
        strong = {self.names.index(n) + 1 for n in ("INS", "VILE", "ADJ", "CURSE", "SWEAR", "GRP", "SEX", "KILL", "HATE")}
        core = {self.names.index(n) + 1 for n in ("INS", "SLUR", "CURSE", "SWEAR", "SEX")}
        self.trie = Trie(w for w, c in self.cls.items() if c in strong and len(w) >= 4)
        self.core_trie = Trie(w for w, c in self.cls.items() if c in core and len(w) >= 3)
        self.run_trie = Trie(w for w in self.cls if w.isalpha())
        self.core = {w for w, c in self.cls.items() if c in core}
        self.second = {w for w, c in self.cls.items() if c == self.names.index("YOU") + 1}
        self.ordinary = ordinary_words()
        self.memo: dict[str, tuple[int, int]] = {}

    def word(self, word: str) -> tuple[int, int]:
        """(id of the entry the word is or is written to look like, else of the word; id of its own spelling)."""
        got = self.memo.get(word)
        if got is None:
            if word.isdigit():
                got = (NUMBER, NUMBER)
            else:
                found, own = self._find(word), self.first_hash + _hash(word)
                got = (self.id[found], own) if found else (own, own)
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = got
        return got

    def _find(self, word: str) -> str | None:
        if word in self.cls:
            return word
        if "'" in word:
            head = word.split("'")[0]
            return self._find(word.replace("'", "")) or (self._find(head) if len(head) > 1 else None)
        if word in self.ordinary or 3 * sum(c.isdigit() for c in word) > 2 * len(word):
            return None
        if len(word) > 24:  # no entry is nearly as long, however many letters are stretched
            word = _STRETCH2.sub(r"\1\1", word)
        if "*" in word:
            body = word.translate(_LEET)
            if not re.fullmatch(r"[^\W\d_][^\W\d_*]*\*[^\W\d_*]*(?:\*[^\W\d_*]*)*", body) or sum(c != "*" for c in body) < 2:
                return None
            hit = self.core_trie.near(body, 0)
            return hit[1] if hit else None
        for pattern, kept in ((_STRETCH2, r"\1"), (_STRETCH2, r"\1\1"), (_STRETCH1, r"\1")):
            short = pattern.sub(kept, word)
            if len(short) + 2 <= len(word) and (short in self.cls or (short := self._near(short, self.trie) or "")):
                return short
        if word.isalpha() and (word.isascii() or not any(c.isascii() for c in word)):
            hit = self._near(word, self.trie)
            if hit or word.isascii():
                return hit
        for table in (_LEET, _LEET_L):
            plain = word.translate(_LOOKALIKE).translate(table)
            if plain.isalpha() and plain != word and any(c.isalpha() for c in word):
                if plain in self.cls:
                    return plain
                if hit := self._near(plain, self.core_trie):
                    return hit
        return None

    def _near(self, word: str, trie: Trie) -> str | None:
        """The nearest entry: one error from four letters on (of four letters only one left out), two from nine."""
        if word in self.cls:
            return word
        if word in self.ordinary or not 4 <= len(word) <= 24:
            return None
        hit = trie.near(word, 2 if len(word) >= 9 else 1)
        if not hit or len(hit[1]) <= 4:
            return None
        return hit[1]

    def _segment(self, plain: str) -> list[str]:
        """``plain`` as words: as many letters as can be in strong words, then in any words of the lexicon, in the fewest pieces."""
        best: list[tuple] = [(0, 0, 0, ())] * (len(plain) + 1)  # of what begins there: strong letters, known letters, -pieces, words
        for at in range(len(plain) - 1, -1, -1):
            options = [(best[at + 1][0], best[at + 1][1], best[at + 1][2] - 1, (plain[at], *best[at + 1][3]))]
            for w in self.run_trie.prefixes(plain, at):
                rest = best[at + len(w)]
                options.append((rest[0] + (len(w) if len(w) >= 3 and w in self.core else 0), rest[1] + len(w), rest[2] - 1, (w, *rest[3])))
            best[at] = max(options, key=lambda o: o[:3])
        return list(best[0][3])

    def unspace(self, text: str) -> str:
        """Letters set apart by blanks, dots or dashes, joined where they spell lexicon words.

        All words of a run are joined, whatever separators stand between them; a run without a strong
        word only if it is all words, one of them in the second person.
        """

        def join(m: re.Match) -> str:
            run = m.group()
            words = self._segment(run[::2].translate(_LOOKALIKE).translate(_LEET))
            strong = any(len(w) >= 3 and w in self.core for w in words)
            if not strong and not (any(len(w) >= 3 and w in self.second for w in words) and all(w in self.cls for w in words)):
                return run
            out, at = [], 0
            for w in words:
                at += len(w)
                out.append(w + " " if len(w) > 1 or w in self.cls else run[2 * (at - 1) : 2 * at])
            return "".join(out)

        return _SPACED.sub(join, text)

    def read(self, text: str | None) -> list[tuple[int, int]]:
        """(id, id of the own spelling) of every word and mark."""
        out: list[tuple[int, int]] = []
        if not text:
            return out
        memo, end, quote, mark = self.memo, (END, END), (QUOTE, QUOTE), (MARK, MARK)
        for token in _WORD.findall(self.unspace(fold(text))):
            known = memo.get(token)
            if known is not None:
                out.append(known)
                continue
            first = token[0]
            if first in _QUOTES:
                out.append(quote)
            elif first in _ENDS:
                out.append(end)
            elif first in ",;:":
                out.append(mark)
            elif first > "〹" and re.match(rf"[{_CJK}]", first):
                out.extend(self._letters(unicodedata.normalize("NFKC", token)))
            else:
                out.append(self.word(token))
        return out

    def _letters(self, text: str) -> Iterator[tuple[int, int]]:
        """Entries (the longest first) and single letters of a text without blanks."""
        at = 0
        while at < len(text):
            hit = max(self.cjk.prefixes(text, at), key=len, default="")
            own = self.first_hash + _hash(hit or text[at])
            yield (self.id[hit], own) if hit else (own, own)
            at += len(hit) or 1


@lru_cache(maxsize=1)
def reader() -> Reader:
    return Reader()


class Features:
    """Windows of a batch of texts as rows of feature numbers below 2**FEATURE_BITS, and the prior weights.

    Numbers below ``base`` are exact (bias, class of the recognised word, whether it begins or ends its
    sentence, class pairs by side); words
    and ordered pairs of words at most three apart are hashed.
    """

    def __init__(self, r: Reader) -> None:
        self.r, self.n = r, len(r.names) + 1
        self.anchor = np.zeros(self.n, dtype=bool)
        self.anchor[[r.names.index(a) + 1 for a in lexicon.ANCHORS]] = True
        self.base = 1 + 3 * self.n + self.n * self.n * 4
        off = np.arange(-WINDOW, WINDOW + 1)
        self.off = off
        self.side = np.where(off < 0, np.where(off >= -2, 0, 1), np.where(off <= 2, 2, 3))
        self.kind = np.zeros(self.n, dtype=np.int8)
        for i, k in enumerate(CATEGORIES):
            for name in KINDS.get(k, "").split():
                self.kind[r.names.index(name) + 1] = i

    def _mix(self, a: np.ndarray, salt: int) -> np.ndarray:
        x = (a.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return (self.base + (x >> np.uint64(33)) % np.uint64((1 << FEATURE_BITS) - self.base)).astype(np.int32)

    def priors(self) -> np.ndarray:
        w, name = np.zeros(1 << FEATURE_BITS, dtype=np.float32), {n: i for i, n in enumerate(self.r.names, 1)}
        w[0] = lexicon.BIAS
        for line in lexicon.PRIORS.strip().splitlines():
            a, *rest = line.split()
            if len(rest) == 1:
                w[1 + name[a]] = float(rest[0])
                continue
            if rest[0] in ("FIRST", "LAST"):
                w[1 + (1 + (rest[0] == "LAST")) * self.n + name[a]] = float(rest[1])
                continue
            for side in _SIDES[rest[1]]:
                w[self._pair(np.array(name[a]), np.array(name[rest[0]]), side)] += float(rest[2])
        for weight, words in self.r.phrases:
            a, b = (np.array([self.r.id[x]], dtype=np.uint64) for x in words)
            w[self._mix(a << np.uint64(24) | b, 2)] = weight
        return w

    def _pair(self, a, b, side):
        return 1 + 3 * self.n + (a * self.n + b) * 4 + side

    def rows(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(features, text, quoted, category), one row per window.

        Words of a class take part by class in pairs by side; of equal classes on a side the number counts
        once.  A place outside the sentence is feature -1.
        """
        flat, lengths = [], []
        for t in texts:
            ids = self.r.read(t if isinstance(t, str) else None)
            flat += ids
            lengths.append(len(ids))
        both = np.array(flat, dtype=np.int32).reshape(-1, 2)
        w, own = both[:, 0], both[:, 1]
        doc = np.repeat(np.arange(len(lengths)), lengths)
        ends, quotes = w == END, w == QUOTE
        sentence = np.cumsum(ends) + doc  # grows at each end and each text
        count = np.concatenate([[0], np.cumsum(quotes)])
        begin = np.concatenate([[0], np.cumsum(lengths)])[:-1].astype(np.int64)
        total = count[np.concatenate([begin[1:], [len(w)]])] - count[begin] if len(lengths) else np.zeros(0, int)
        before = count[:-1] - np.repeat(count[begin], lengths) if len(w) else np.zeros(0, int)
        quoted = (before % 2 == 1) & (before < np.repeat(total, lengths)) if len(w) else np.zeros(0, bool)
        keep = ~(ends | quotes)
        w, own, doc, sentence, quoted = w[keep], own[keep], doc[keep], sentence[keep], quoted[keep]
        cls = np.where(w < self.r.first_hash, self.r.class_of[np.minimum(w, self.r.first_hash - 1)], 0) if len(w) else w
        at = np.flatnonzero(self.anchor[cls])
        if not len(at):
            return np.empty((0, 1), np.int32), at, np.zeros(0, bool), np.zeros(0, int)
        place = at[:, None] + self.off
        inside = (place >= 0) & (place < len(w))
        place = np.clip(place, 0, len(w) - 1)
        inside &= sentence[place] == sentence[at][:, None]
        words = np.where(inside, w[place], 0).astype(np.uint64)
        c = np.where(inside, cls[place], 0)
        mine = c[:, WINDOW]
        pair = self._pair(mine[:, None], c, self.side)
        pair[:, WINDOW] = -1
        pair[c == 0] = -1
        pair = np.sort(pair, axis=1)
        pair[:, 1:][pair[:, 1:] == pair[:, :-1]] = -1
        ends = [np.where(inside[:, WINDOW + d], -1, 1 + k * self.n + mine)[:, None] for k, d in ((1, -1), (2, 1))]
        parts = [np.zeros((len(at), 1), np.int32), 1 + mine[:, None], *ends, pair, np.where(inside, self._mix(words, 1), -1), self._mix(own[at].astype(np.uint64)[:, None], 3)]
        for gap in (1, 2, 3):
            a, b = words[:, :-gap], words[:, gap:]
            parts.append(np.where((a > 0) & (b > 0), self._mix(a << np.uint64(24) | b, 2), -1))
        return np.concatenate(parts, axis=1).astype(np.int32), doc[at], quoted[at], self.kind[mine]


@lru_cache(maxsize=1)
def features() -> Features:
    return Features(reader())


def _logits(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the rows' weights; the last weight is 0, for feature -1."""
    return weights[rows].sum(1)


def fit_weights(texts: list[str | None], rate: np.ndarray, judged: np.ndarray, rounds: int = 25, steps: int = 8, l2: float = 1.0, exact_l2: float = 1.0, step: float = 0.15) -> np.ndarray:
    """Weights fitted to reviewed texts: ``rate`` is the share of abusive judgements of ``judged``.

    A text is as abusive as its worst window (multiple-instance logistic regression): in turn the worst
    windows are chosen by the weights and the weights moved along the loss of those windows, with a pull
    towards the priors.  Reviewers err, so one judgement says less than several.
    """
    f = features()
    start = np.append(f.priors(), np.float32(0))
    rows, doc, _, _ = f.rows(texts)
    if not len(rows) or not len(texts):
        return start
    target = (rate * judged + 0.06) / (judged + 0.12)
    weight = np.minimum(judged, 3.0) / 3.0 * 0.5 + 0.5
    w = start.astype(np.float64)
    pull = np.full(len(w), l2)
    pull[: f.base] = exact_l2
    seen = np.zeros(len(w))
    order = np.arange(len(doc))
    for _ in range(rounds):
        z = _logits(rows, w)
        by = np.lexsort((order, -z, doc))
        d = doc[by]
        first = np.concatenate([[True], d[1:] != d[:-1]])
        second = np.concatenate([[False], first[:-1]]) & ~first
        pick = np.concatenate([by[first], by[second & (target[d] < 0.5)]])  # of a harmless text the two worst
        x, y, v = rows[pick], target[doc[pick]], weight[doc[pick]]
        for _ in range(steps):
            p = 1 / (1 + np.exp(-_logits(x, w)))
            g = np.bincount(np.where(x < 0, len(w) - 1, x).ravel(), np.repeat((p - y) * v, x.shape[1]), minlength=len(w))
            g += pull * (w - start)
            g[-1] = 0
            seen += g * g
            w -= step * g / np.sqrt(seen + 1e-6)
    return w.astype(np.float32)


def labelled_sample(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> pd.DataFrame:
    """(text, rate, judged) of at most ``most`` reviewed documents: those of least hash of doc_id.

    A judgement that is null or repeated (same reviewer and time) doesn't count.
    """
    judged = labels.where("doc_id is not null and abusive is not null").dropDuplicates(["doc_id", "reviewer_no", "reviewed_at", "abusive"])
    per = judged.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.avg("abusive").alias("rate"), F.count(F.lit(1)).alias("judged"))
    sample = per.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # the documented bound of the sample
    slim = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.join(F.broadcast(sample), "doc_id").where("text is not null").orderBy(F.xxhash64("doc_id")).select("text", "rate", "judged").toPandas()


def trained(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> np.ndarray:
    """Weights for ``score_documents`` from a bounded sample of reviewed documents."""
    pdf = labelled_sample(documents, labels, most)
    return fit_weights(pdf["text"].tolist(), pdf["rate"].to_numpy(float), pdf["judged"].to_numpy(float))


def score_texts(texts, weights: np.ndarray) -> np.ndarray:
    """Score, own, quoted and the four categories of each text: the probability of the worst window of each kind."""
    out = np.zeros((len(texts), 3 + len(CATEGORIES)))
    rows, doc, quoted, kind = features().rows(texts)
    if len(rows):
        p = 1 / (1 + np.exp(-_logits(rows, weights.astype(np.float64))))
        for column, part in ((0, slice(None)), (1, ~quoted), (2, quoted), *((3 + k, kind == k) for k in range(len(CATEGORIES)))):
            np.maximum.at(out[:, column], doc[part], p[part])
    return out


_SCHEMA = "doc_id bigint, source string, score double, own_score double, quoted_score double, insult double, threat double, hateful double, sexual double"


def score_documents(documents: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """(doc_id, source, score, own_score, quoted_score, insult, threat, hateful, sexual), one row per document.

    ``weights`` come from ``trained``; without them the priors hold.  Scores are probabilities.  Null, empty
    and blank texts score 0.  Whole texts are scored.  Null ids and sources stay; repeated rows stay; an empty
    table gives no rows; further columns are ignored.
    """
    slim = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    held = documents.sparkSession.sparkContext.broadcast(np.append(features().priors(), np.float32(0)) if weights is None else weights)  # 2**18 numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [score_texts(pdf["text"].iloc[i : i + 2000].tolist(), held.value) for i in range(0, len(pdf), 2000)]
            out = np.concatenate(parts) if parts else np.zeros((0, 3 + len(CATEGORIES)))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], **{n: out[:, i] for i, n in enumerate(("score", "own_score", "quoted_score", *CATEGORIES))}})

    return spread(slim).mapInPandas(run, _SCHEMA)


def flagged(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id) of the documents to review or exclude."""
    return scores.where(F.col("score") >= threshold).select("doc_id")


def source_rates(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(source, n_documents, n_flagged, rate, n_quoted_only): a null source is a source of its own."""
    bad = F.col("score") >= threshold
    return scores.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_documents"), F.count_if(bad).alias("n_flagged"), (F.count_if(bad) / F.count(F.lit(1))).alias("rate"),
        F.count_if(bad & (F.col("own_score") < threshold)).alias("n_quoted_only"),
    )
