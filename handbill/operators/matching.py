"""How alike names are: bounds of the ratio for whole batches, then the ratio itself; clusters of names in order."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np

#: Characters of a normal name. Others count as one that is like no other.
LETTERS = " 0123456789abcdefghijklmnopqrstuvwxyz"
CODE = np.full(256, len(LETTERS), np.int64)
CODE[np.frombuffer(LETTERS.encode(), np.uint8)] = np.arange(len(LETTERS))
#: Pairs of names whose bounds are worked out at once.
TOGETHER = 1 << 18


class Names:
    """Normal names with what bounds of their ratio need: sizes, counts of characters, and where each character stands."""

    def __init__(self, names: list[str]):
        self.names = names
        self.size = np.array([len(x) for x in names], np.int64)
        flat = CODE[np.frombuffer("".join(names).encode("latin-1", "replace"), np.uint8)]
        of = np.repeat(np.arange(len(names)), self.size)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.counts = np.bincount(of * (len(LETTERS) + 1) + flat, minlength=len(names) * (len(LETTERS) + 1)).reshape(len(names), -1).astype(np.int32)
        self.codes = np.full((len(names), max(64, int(self.size.max(initial=0)))), len(LETTERS) + 1, np.int64)
        self.codes[of, place] = flat
        self.where = np.zeros((len(names), len(LETTERS) + 2), np.uint64)
        near = place < 64
        np.bitwise_or.at(self.where, (of[near], flat[near]), np.uint64(1) << place[near].astype(np.uint64))

    def by_characters(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ratios if all characters that two names share were matched: none is above that."""
        shared = np.minimum(self.counts[a], self.counts[b]).sum(axis=1)
        return 2.0 * shared / np.maximum(self.size[a] + self.size[b], 1)

    def by_subsequence(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ratios if a longest common subsequence were matched: matched blocks are one. Names of over 64 characters aren't bounded.

        A bit of `open_` for each character of a says that it ends no longer subsequence than those before it.
        """
        out = np.ones(len(a))
        short = np.flatnonzero((self.size[a] <= 64) & (self.size[b] <= 64))
        a, b = a[short], b[short]
        open_ = np.full(len(a), ~np.uint64(0))
        for k in range(int(self.size[b].max(initial=0))):
            hit = open_ & self.where[a, self.codes[b, k]]
            open_ = (open_ + hit) | (open_ - hit)
        size = self.size[a].astype(np.uint64)
        whole = np.where(size == 64, ~np.uint64(0), (np.uint64(1) << (size & np.uint64(63))) - np.uint64(1))
        out[short] = 2.0 * np.bitwise_count(~open_ & whole) / np.maximum(self.size[a] + self.size[b], 1)
        return out

    def likely(self, a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Which of the pairs no bound keeps below `least`; empty names are like none."""
        kept = []
        for k in range(0, len(a), TOGETHER):
            left, right, low = a[k : k + TOGETHER], b[k : k + TOGETHER], least[k : k + TOGETHER]
            short, long = np.minimum(self.size[left], self.size[right]), np.maximum(self.size[left], self.size[right])
            at = np.flatnonzero((short > 0) & (2.0 * short / np.maximum(short + long, 1) >= low))
            at = at[self.by_characters(left[at], right[at]) >= low[at]]
            at = at[self.by_subsequence(left[at], right[at]) >= low[at]]
            kept.append(at + k)
        return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def ratio(later: str, earlier: str) -> float:
    """Ratcliff-Obershelp ratio, which depends on the order of the two."""
    return SequenceMatcher(None, later, earlier).ratio()


def ratios(later: list[str], earlier: list[str], least: float | np.ndarray) -> np.ndarray:
    """The ratio of each pair, or 0 where it can't reach `least`."""
    known = {x: k for k, x in enumerate(dict.fromkeys([*later, *earlier]))}
    names = Names(list(known))
    a, b = (np.array([known[x] for x in side], np.int64) for side in (later, earlier))
    out = np.zeros(len(a))
    for k in names.likely(a, b, np.broadcast_to(np.asarray(least, float), a.shape)).tolist():
        out[k] = ratio(later[k], earlier[k])
    return out


class FirstFit:
    """Clusters of one run, event by event: each joins the first cluster that has a match, or opens one.

    Events of one name and date match alike, so the least root that each such group has reached is all that is kept. Clusters
    are in the order of their first events, so the first with a match is the least root among the groups that match.
    """

    def __init__(self, strong: float, weak: float, groups: dict[tuple[str, str], int] | None = None, known: dict[tuple[str, str], float] | None = None):
        """groups: (name, date) to root, as after earlier events. known: ratios that other runs have worked out."""
        self.strong, self.weak = strong, weak
        self.groups = dict(groups or {})
        self.known = {} if known is None else known

    def matches(self, later: list[str], every: list[str], dated: dict[str, set[str]]) -> dict[str, list[tuple[str, bool]]]:
        """Names that each of `later` matches, and whether whatever the dates; dated: the names that have each date."""
        names = Names(every)
        place = {x: k for k, x in enumerate(every)}
        own = np.array([place[x] for x in later], np.int64)
        on_date = [np.array([place[x] for x in group], np.int64) for group in dated.values() if len(group) > 1] if self.weak < self.strong else []
        out: dict[str, list[tuple[str, bool]]] = {x: [] for x in later}
        step = max(1, TOGETHER // max(len(every), 1))
        for k in range(0, len(own), step):
            part = own[k : k + step]
            least, row = np.full((len(part), len(every)), self.strong), np.full(len(every), -1)
            row[part] = np.arange(len(part))
            for group in on_date:
                rows = row[group]
                least[rows[rows >= 0, None], group] = self.weak
            a, b, least = np.repeat(part, len(every)), np.tile(np.arange(len(every)), len(part)), least.ravel()
            for at in names.likely(a, b, least).tolist():
                pair = (every[a[at]], every[b[at]])
                if pair not in self.known:
                    self.known[pair] = ratio(*pair)
                if self.known[pair] >= least[at]:
                    out[pair[0]].append((pair[1], self.known[pair] >= self.strong))
        return out

    def add(self, ordinals: list[int], names: list[str], dates: list[str]) -> list[int]:
        """Roots of events in order, whose ordinals are above all before; a blank date is none."""
        dated: dict[str, set[str]] = {}
        by_name: dict[str, set[str]] = {}
        for name, date in [*self.groups, *zip(names, dates, strict=True)]:
            if name:
                by_name.setdefault(name, set()).add(date)
                if date:
                    dated.setdefault(date, set()).add(name)
        alike = self.matches([x for x in dict.fromkeys(names) if x], list(by_name), dated)
        near: dict[tuple[str, str], list[tuple[str, str]]] = {}
        roots = []
        for ordinal, group in zip(ordinals, zip(names, dates, strict=True), strict=True):
            if group not in near:
                name, date = group
                near[group] = [(y, d) for y, sure in alike.get(name, []) for d in by_name[y] if sure or (date and d == date)]
            root = min([self.groups[g] for g in near[group] if g in self.groups], default=ordinal)
            roots.append(root)
            if group[0]:
                self.groups[group] = min(self.groups.get(group, root), root)
        return roots
