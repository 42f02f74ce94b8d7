"""Which catalogue molecule a name means: formula, list of atoms or common name, however written."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

_COMMON = (
    re.compile(r"(?:called|known as|named|structure (?:for|of))\s+(.+?)\s*(?:[,;(.]|$)", re.I),
    re.compile(r"^(.+?)\s*\("),
)
_DASHES = dict.fromkeys(map(ord, "‐‑‒–—−⁻₋﹣－"), "-") | dict.fromkeys(map(ord, "⁺₊＋"), "+")
_ATOM, _DIGITS = re.compile(r"([A-Z][a-z]?)(\d*)"), re.compile(r"\d*")


def tidy(name: str) -> str:
    """One spelling of dashes, digits and blanks; markup of sub- and superscripts gone."""
    plain = unicodedata.normalize("NFKC", name.translate(_DASHES)).translate(_DASHES)
    plain = re.sub(r"\\(?:mathrm|text|ce|rm|mathsf)\b", "", plain)
    return re.sub(r"\s+", " ", re.sub(r"[$_^{}\\'\"`*]|</?su[bp]>", "", plain)).strip()


def split_charge(text: str) -> tuple[str, int | None]:
    """(body, charge): a trailing run of signs, also in brackets, is the charge; None if there is none."""
    m = re.search(r"[\s\[(]*(\++|-+)[\s\])]*$", text)
    if not m:
        return text, None
    signs = m.group(1)
    return text[: m.start()], len(signs) * (1 if signs[0] == "+" else -1)


def atoms_of(body: str, elements: frozenset[str], most: int) -> tuple[str, ...] | None:
    """The atoms in order, counts written out; None if the text isn't a formula of at most ``most`` of these elements."""
    out: list[str] = []
    at = 0
    for m in _ATOM.finditer(body):
        if m.start() != at or m.group(1) not in elements:
            return None
        n = _count(m.group(2), most)
        if len(out) + n > most:
            return None
        out += [m.group(1)] * n
        at = m.end()
    return tuple(out) if out and at == len(body) else None


def _count(digits: str, most: int) -> int:
    """The number of atoms that digits say; one more than ``most`` for any larger number."""
    digits = digits.lstrip("0") if digits.strip("0") else digits[:1]
    return 1 if not digits else most + 1 if len(digits) > len(str(most)) else int(digits)


def readings(body: str, elements: frozenset[str], most: int) -> list[tuple[str, ...]]:
    """All ways to read a text as at most ``most`` atoms without regard to case.

    ``most`` is the size of the catalogue's largest molecule: longer readings can't be one of its entries.
    """
    low, found = body.lower(), []

    def walk(at: int, atoms: tuple[str, ...]) -> None:
        if at == len(low):
            found.append(atoms)
            return
        for n in (2, 1):
            symbol = low[at : at + n].capitalize()
            if len(symbol) == n and symbol in elements:
                m = _DIGITS.match(low, at + n)
                times = _count(m.group(), most)
                if len(atoms) + times <= most:
                    walk(m.end(), atoms + (symbol,) * times)

    if low:
        walk(0, ())
    return found


class MoleculeNames:
    """Resolves names against a catalogue of (molecule_id, name, symbols, charge, description).

    The catalogue's size is fixed; entries made of the same atoms in another order are different
    molecules, told apart by the order, which may be read from either end.
    """

    def __init__(self, entries: list[tuple[int, str, list[str], int | None, str | None]]) -> None:
        self.exact = {name: i for i, name, *_ in entries if name is not None}
        self.elements = frozenset(s for _, _, symbols, *_ in entries for s in symbols or [] if s)
        self.most = max((len(symbols or []) for _, _, symbols, *_ in entries), default=0)
        self.common: dict[str, int] = {}
        self.sequences: dict[tuple, set[int]] = {}
        self.bags: dict[tuple, set[int]] = {}
        for i, name, symbols, charge, description in entries:
            for pattern in _COMMON:
                m = pattern.search(description or "")
                if m:
                    self.common.setdefault(self._phrase(m.group(1)), i)
                    break
            forms = {tuple(symbols or ())}
            if name is not None and (f := atoms_of(self._body(split_charge(tidy(name))[0]), self.elements, self.most)):
                forms.add(f)
            for f in forms - {()}:
                for order in (f, f[::-1]):
                    self.sequences.setdefault((order, charge or 0), set()).add(i)
                self.bags.setdefault((tuple(sorted(Counter(f).items())), charge or 0), set()).add(i)
        self.memo: dict[str, int | None] = {}

    def resolve(self, name: str | None) -> int | None:
        """The molecule a name means; None for null and blank names, unknown ones and those that fit several entries."""
        if name is None:
            return None
        if name not in self.memo:
            if len(self.memo) >= 100_000:
                self.memo.clear()
            self.memo[name] = self._resolve(name)
        return self.memo[name]

    @staticmethod
    def _phrase(text: str) -> str:
        return re.sub(r"[\s_\-]+", " ", tidy(text)).casefold().strip()

    @staticmethod
    def _body(text: str) -> str:
        return re.sub(r"[\s\-=#≡.,;:·()\[\]]", "", text)

    def _match(self, atoms: tuple[str, ...], charge: int | None) -> set[int]:
        """Entries of these atoms: by order, else by number if that leaves one; without a charge, the neutral one first."""
        for c in (0, None) if charge is None else (charge,):
            for table, key in ((self.sequences, atoms), (self.bags, tuple(sorted(Counter(atoms).items())))):
                hits = set().union(*(v for (k, q), v in table.items() if k == key and (c is None or q == c)))
                if len(hits) == 1:
                    return hits
        return set()

    def _resolve(self, name: str) -> int | None:
        if name in self.exact:
            return self.exact[name]
        text = tidy(name)
        if not text:
            return None
        if (i := self.common.get(self._phrase(text))) is not None:
            return i
        body, charge = split_charge(text)
        body = self._body(body)
        atoms = atoms_of(body, self.elements, self.most)
        if atoms and len(hits := self._match(atoms, charge)) == 1:
            return next(iter(hits))
        exact = [r for r in readings(body, self.elements, self.most) if self._match(r, charge)]
        hits = set().union(*(self._match(r, charge) for r in exact)) if exact else set()
        if len(hits) > 1:  # an ordered reading beats one by number of atoms
            hits = set().union(*(self.sequences.get((r, charge or 0), set()) for r in exact))
        return next(iter(hits)) if len(hits) == 1 else None
