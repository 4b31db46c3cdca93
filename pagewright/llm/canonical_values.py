"""Mapping free-entered values to a reference list.

The names of all entries (canonical spelling, label, other names) form a trie. Besides the name as
written it holds alias paths: the words in alphabetical order, and, from inside every word, a jump to the
end of the word, where it may be cut. A Levenshtein automaton (insertions, deletions, substitutions, swaps of
neighbours) walks the trie; its states are bit masks over the positions of the value, one per number
of errors and 64 positions, so that one numpy step moves the automata of a whole Arrow batch of values. Branches
in which no automaton is alive are left at once. Names and values may be of any length and in any script.
Longer values whose words may stand in any order are aligned with the names word by word (`fewest_errors`), which
tries all orders without listing them.

All entries within the length-dependent distance are returned, the closest first.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain, permutations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.session import materialize

#: Entries of one block; a longer reference list is searched block by block.
MAX_ENTRIES = 50_000
#: Values a worker remembers.
MEMO = 200_000
#: Values that are searched at once.
BATCH = 4096
_WORD = regex.compile(r"[\p{L}\p{N}][\p{L}\p{N}\p{M}]*")

_LEAD = re.compile(
    r"^[^\w§]*(?:§+|(?:sec|sect|section|art|article|part|pt|chapter|ch|no)\b[\W_]*(?=[0-9ivx]+\b)|"
    r"(?:sec|sect|section|art|article)\b(?=\W)|\(?(?:\d{1,3}|[ivxl]{1,5}|[a-z])(?:[.):\]]+|\s+[-–—]+(?=\s|[a-z]))|\d{1,3}\s+)\s*"
)
_TAIL = re.compile(r"(?:[\W_]+(?:pt|part|page|p|no|sec|sect)?[\W_]*\d{1,4}|[\W_]+(?:cont|contd|continued)|[\W_]+(?:sec|sect|section))[\W_]*s?$")


def words_of(value: str) -> list[str]:
    """The words of a value without case, accents (of the general block of combining marks), numbering and
    continuation marks. Vowel signs and other marks of a script stay."""
    s = unicodedata.normalize("NFKD", value).casefold().replace("_", " ")
    s = "".join(c for c in s if not "\u0300" <= c <= "\u036f")
    s = re.sub(r"\s+", " ", s).strip()
    for pattern in (_LEAD, _TAIL):
        while True:
            t = pattern.sub("", s, count=1)
            if t == s or not re.search(r"[^\W_]", t):
                break
            s = t
    return _WORD.findall(s)


def allowed(length: int) -> int:
    """Most errors for a value (or name) of so many letters."""
    return 0 if length < 4 else 1 if length < 6 else 2 if length < 8 else 3 if length < 12 else 4 if length < 17 else 5


def _least_letters(word: str) -> int:
    """A word of a name may be cut to half of its letters at least, and to three."""
    return max(3, -(-len(word) // 2))


def _letter_counts(text: str, place: dict[str, int]) -> np.ndarray:
    """How often each letter of `place` stands in the text; at the end all other letters together."""
    n = np.zeros(len(place) + 1, np.int64)
    for c in text:
        n[place.get(c, -1)] += 1
    return n


def fewest_errors(words: list[str], name: tuple[str, ...], limit: int) -> int | None:
    """The fewest errors between the name and the words joined in any order, as the automaton counts
    them, if at most `limit`. One row of errors per position in the name is kept for every set of used
    words and last word; positions that the letters left can't bring within the limit are dropped."""
    words, text = sorted(words), "".join(name)
    size, big = len(text), limit + 1
    place = {c: i for i, c in enumerate(sorted(set(text)))}
    jumps, end = {}, 0
    for w in name:
        end += len(w)
        jumps[end] = range(1, len(w) - _least_letters(w) + 1)
    left = np.stack([_letter_counts(text[i:], place) for i in range(size + 1)])
    counts = [_letter_counts(w, place) for w in words]

    def finish(row: list[int], at: int) -> None:
        """Letters of the name that are missing, from position `at` on."""
        for i in range(at, size + 1):
            if i and row[i - 1] + 1 < row[i]:
                row[i] = row[i - 1] + 1
            for back in jumps.get(i, ()):
                if row[i - back] + 1 < row[i]:
                    row[i] = row[i - back] + 1

    first = [0] + [big] * size
    finish(first, 1)
    # (last word, used words) -> the rows before and after the last letter
    states: dict[tuple[int, int], tuple[list[int] | None, list[int]]] = {(-1, 0): (None, first)}
    for _ in words:
        after: dict[tuple[int, int], tuple[list[int] | None, list[int]]] = {}
        need: dict[int, list[int]] = {}
        for (last, used), (before, row) in states.items():
            for j, word in enumerate(words):
                if used >> j & 1 or j and word == words[j - 1] and not used >> (j - 1) & 1:
                    continue
                old, now, previous = before, row, words[last][-1] if last >= 0 else ""
                for c in word:
                    new = [min(x + 1, big) for x in now]
                    for i in range(1, size + 1):
                        if (x := now[i - 1] + (text[i - 1] != c)) < new[i]:
                            new[i] = x
                        if i > 1 and old and text[i - 1] == previous and text[i - 2] == c and old[i - 2] + 1 < new[i]:
                            new[i] = old[i - 2] + 1
                    finish(new, 1)
                    old, now, previous = now, new, c
                to = used | 1 << j
                if to not in need:
                    rest = sum((counts[k] for k in range(len(words)) if not to >> k & 1), np.zeros(len(place) + 1, np.int64))
                    need[to] = np.maximum(rest - left, 0).sum(axis=1).tolist()
                now = [x if x + y <= limit else big for x, y in zip(now, need[to], strict=True)]
                if min(now) > limit and min(old) > limit:
                    continue
                if (j, to) in after:
                    a, b = after[j, to]
                    old, now = [*map(min, a, old)], [*map(min, b, now)]
                after[j, to] = old, now
        states = after
    best = min((row[size] for _, row in states.values()), default=big)
    return best if best <= limit else None


@dataclass(eq=False)
class Node:
    children: dict[str, Node] = field(default_factory=dict)
    entries: list[int] = field(default_factory=list)
    #: the ends of words that may be cut here
    cuts: dict[Node, None] = field(default_factory=dict)
    letters: int = 0
    #: numbers of the node and of the last node below it, in the order of a walk
    first: int = 0
    last: int = 0


def _up(x: np.ndarray) -> np.ndarray:
    """Every position moved on by one; axis -2 holds the 64-bit words of a mask."""
    out = x << np.uint64(1)
    if x.shape[-2] > 1:
        out[..., 1:, :] |= x[..., :-1, :] >> np.uint64(63)
    return out


def _down(x: np.ndarray) -> np.ndarray:
    out = x >> np.uint64(1)
    if x.shape[-2] > 1:
        out[..., :-1, :] |= x[..., 1:, :] << np.uint64(63)
    return out


class Matcher:
    """Trie of (entry id, name) pairs."""

    def __init__(self, names: list[tuple[int, str]]):
        self.root = Node()
        self.paths: list[tuple[int, tuple[str, ...]]] = []
        for entry, name in names:
            words = words_of(name)
            if not words:
                continue
            for path in {tuple(words), tuple(sorted(words))}:
                self._add(entry, path)
                self.paths.append((entry, path))
        self._number()
        self.place = {c: i for i, c in enumerate(sorted({c for _, p in self.paths for w in p for c in w}))}
        self.letters = np.stack([_letter_counts("".join(p), self.place) for _, p in self.paths]) if self.paths else np.zeros((0, 1), np.int64)
        self.sizes = np.array([sum(map(len, p)) for _, p in self.paths], np.int64)

    def _add(self, entry: int, words: tuple[str, ...]) -> None:
        node = self.root
        for w in words:
            inside = []
            for p, c in enumerate(w, 1):
                node = node.children.setdefault(c, Node(letters=node.letters + 1))
                if _least_letters(w) <= p < len(w):
                    inside.append(node)
            for n in inside:
                n.cuts[node] = None
        if entry not in node.entries:
            node.entries.append(entry)

    def _number(self) -> None:
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            node.first = len(order)
            order.append(node)
            stack.extend(node.children.values())
        for node in reversed(order):
            node.last = max([node.first, *(c.last for c in node.children.values())])

    def search(self, queries: list[str]) -> list[dict[int, int]]:
        """Per query (joined words) the entries within its distance: {entry: errors}."""
        out: list[dict[int, int]] = [{} for _ in queries]
        # queries whose masks take as many words walk together
        width: dict[int, list[int]] = {}
        for i, q in enumerate(queries):
            if q:
                width.setdefault(len(q) // 64 + 1, []).append(i)
        for w, index in width.items():
            for at in range(0, len(index), max(1, BATCH // w)):
                self._walk(queries, np.array(index[at : at + max(1, BATCH // w)], np.int64), w, out)
        return out

    def _walk(self, queries: list[str], index: np.ndarray, width: int, out: list[dict[int, int]]) -> None:
        qs = [queries[i] for i in index]
        length = np.array([len(q) for q in qs])
        # a name may be longer than the value, then its own length counts
        most = np.array([allowed(len(q) + 2) for q in qs])
        errors = int(most.max())
        masks = {c: np.zeros((width, len(qs)), np.uint64) for c in self.place}
        for i, q in enumerate(qs):
            for p, c in enumerate(q):
                if c in masks:
                    masks[c][p // 64, i] |= np.uint64(1 << p % 64)

        def ones(n: np.ndarray) -> np.ndarray:
            """Masks of the positions 0 to n - 1."""
            bits = np.clip(n[None, :] - 64 * np.arange(width)[:, None], 0, 64)
            return np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << (bits % 64).astype(np.uint64)) - np.uint64(1))

        full = ones(length + 1)
        # levels above a query's own distance stay empty
        may = np.where((np.arange(errors + 1)[:, None] <= most[None, :])[:, None, :], full[None], np.uint64(0))
        start = np.stack([ones(np.full(len(qs), j + 1)) for j in range(errors + 1)]) & may
        last_word, last_bit = length // 64, (length % 64).astype(np.uint64)

        Jumps = list[tuple[Node, np.ndarray]]
        stack: list[tuple[Node, np.ndarray, np.ndarray | None, str, np.ndarray, Jumps]] = [(self.root, start, None, "", np.arange(len(qs)), [])]
        while stack:
            node, state, before, char, alive, jumps = stack.pop()
            here = [s for n, s in jumps if n is node]
            if here:
                state = state.copy()
                for s in here:
                    state[1:] |= s[:-1]
                state &= may[:, :, alive]
            if node.entries:
                done = ((state[:, last_word[alive], np.arange(len(alive))] >> last_bit[alive]) & np.uint64(1)).astype(bool)
                for k in np.flatnonzero(done.any(axis=0)):
                    e = int(done[:, k].argmax())
                    if e <= allowed(max(int(length[alive[k]]), node.letters)):
                        found = out[index[alive[k]]]
                        for entry in node.entries:
                            if e < found.get(entry, 99):
                                found[entry] = e
            jumps = [x for x in jumps if x[0] is not node] + [(n, state) for n in node.cuts]
            for c, child in node.children.items():
                m = masks[c][:, alive]
                nxt = _up(state & m)
                nxt[1:] |= state[:-1] | _up(state[:-1])
                if before is not None and char in masks:
                    nxt[1:] |= _up(_up(before[:-1] & m & _down(masks[char][:, alive])))
                for j in range(1, errors + 1):
                    nxt[j] |= _up(nxt[j - 1])
                nxt &= may[:, :, alive]
                below = [x for x in jumps if child.first <= x[0].first <= child.last]
                self._descend(stack, child, nxt, state, c, alive, below)

    @staticmethod
    def _descend(stack: list, child: Node, state: np.ndarray, before: np.ndarray | None, char: str, alive: np.ndarray, jumps: list) -> None:
        """Go on at `child` with the automata that are alive there; those that only a jump reaches go on
        where it ends."""
        some = state.any(axis=(0, 1))
        if some.any():
            for _, s in jumps:
                some = some | s.any(axis=(0, 1))
            if some.sum() * 2 < len(alive):
                keep = np.flatnonzero(some)
                jumps = [(n, s[:, :, keep]) for n, s in jumps]
                stack.append((child, state[:, :, keep], before[:, :, keep], char, alive[keep], jumps))
            else:
                stack.append((child, state, before, char, alive, jumps))
            return
        rest = sorted(jumps, key=lambda x: x[0].letters)
        while rest:
            to = rest[0][0]
            under = [x for x in rest if to.first <= x[0].first <= to.last]
            rest = [x for x in rest if not to.first <= x[0].first <= to.last]
            some = np.any([s.any(axis=(0, 1)) for _, s in under], axis=0)
            if some.any():
                keep = np.flatnonzero(some)
                under = [(n, s[:, :, keep]) for n, s in under]
                stack.append((to, np.zeros_like(under[0][1]), None, "", alive[keep], under))

    def align(self, words: list[str]) -> dict[int, int]:
        """The entries with a name within the distance of the words in any order: {entry: errors}."""
        found: dict[int, int] = {}
        size = sum(map(len, words))
        # a letter of the value that the name lacks is an error in every order
        lacking = np.maximum(_letter_counts("".join(words), self.place)[None, :] - self.letters, 0).sum(axis=1)
        for k in np.flatnonzero(lacking <= allowed(size + 2)):
            entry, path = self.paths[k]
            most = min(allowed(size + 2), allowed(max(size, int(self.sizes[k]))))
            # a small limit leaves few states, so that the limits are tried in turn
            e = next((e for limit in range(lacking[k], most + 1) if (e := fewest_errors(words, path, limit)) is not None), None)
            if e is not None:
                found[entry] = min(e, found.get(entry, 99))
        return found

    def match(self, values: list[str]) -> list[list[tuple[int, int]]]:
        """Per value the (entry, errors) pairs within its distance, closest first, ties by entry."""
        words = [words_of(v) for v in values]
        typed = ["".join(w) for w in words]
        ordered = ["".join(sorted(w)) for w in words]
        a = self.search(typed)
        for x, y in zip(a, self.search([s if s != t else "" for s, t in zip(ordered, typed, strict=True)]), strict=True):
            for entry, e in y.items():
                x[entry] = min(e, x.get(entry, 99))
        # an error in a first letter also changes the alphabetical order: try every order of few words
        rest = [(i, "".join(p)) for i, w in enumerate(words) if not a[i] and 2 <= len(w) <= 4 for p in permutations(w)]
        for (i, _), y in zip(rest, self.search([q for _, q in rest]), strict=True):
            for entry, e in y.items():
                a[i][entry] = min(e, a[i].get(entry, 99))
        # longer values have too many orders for that
        for i, w in enumerate(words):
            if not a[i] and len(w) > 4:
                a[i].update(self.align(w))
        return [sorted(x.items(), key=lambda t: (t[1], t[0])) for x in a]


_MATCHERS: dict[str, tuple[Matcher, dict]] = {}


def _matcher(key: str, names: list[tuple[int, str]]) -> tuple[Matcher, dict]:
    """The trie of a reference list and the values matched with it so far, once per worker process."""
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(names), {}
    return _MATCHERS[key]


def _is_blank(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[\s\p{Z}\x0b\x1c-\x1f\x{85}\x{200b}\x{feff}]+", "")) == 0


def _names(rows: list, id_col: str, name_cols: list[str], list_cols: list[str]) -> list[tuple[int, str]]:
    out = []
    for r in rows:
        for c in name_cols:
            out += [(r[id_col], r[c])] if r[c] else []
        for c in list_cols:
            out += [(r[id_col], x) for x in r[c] or [] if x]
    return sorted(set(out))


def reference_blocks(entries: DataFrame, id_col: str, name_cols: list[str], list_cols: list[str], size: int = MAX_ENTRIES) -> Iterator[list[tuple[int, str]]]:
    """The names of a reference list as (id, name), in blocks of about `size` entries by a hash of the id; a block
    is all that the driver and the workers hold at once. Entries without an id and null or empty names are left out."""
    cols = entries.select(id_col, *name_cols, *list_cols).where(F.col(id_col).isNotNull())
    blocks = -(-cols.count() // size)
    for b in range(blocks):
        part = cols if blocks == 1 else cols.where(F.pmod(F.xxhash64(id_col), F.lit(blocks)) == b)
        yield _names(part.collect(), id_col, name_cols, list_cols)


def map_values(df: DataFrame, value_col: str, names: list[tuple[int, str]], keep: list[str]) -> DataFrame:
    """`keep` columns and matches array<struct<entry,errors>> of each row of `df`; empty where the
    value means no entry, and for null and blank values. A narrow map: repeated values are
    matched once per worker and remembered, and no value is ever shuffled."""
    src = df.select(*keep, F.col(value_col).alias("__value"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    key = hashlib.sha256(repr(names).encode()).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher, memo = _matcher(key, names)
        for b in batches:
            values = [v for v in b["__value"].unique() if v is not None]
            todo = [v for v in values if v not in memo]
            if len(memo) + len(todo) > MEMO:
                memo.clear()
                todo = values
            for at in range(0, len(todo), BATCH):
                part = todo[at : at + BATCH]
                memo.update(zip(part, matcher.match(part), strict=True))
            got = [[{"entry": e, "errors": n} for e, n in memo.get(v, ())] for v in b["__value"]]
            yield b[keep].assign(matches=got)

    return src.mapInPandas(run, schema + ", matches array<struct<entry:int,errors:int>>")


def map_to_list(
    df: DataFrame, value_col: str, entries: DataFrame, id_col: str, name_cols: list[str], list_cols: list[str], keep: list[str], size: int = MAX_ENTRIES
) -> DataFrame:
    """`map_values` against the entries of a table. A list of more than `size` entries is searched in blocks: the
    different values are matched with every block in turn and meet their rows in one join. An empty list matches
    nothing."""
    blocks = reference_blocks(entries, id_col, name_cols, list_cols, size)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return map_values(df, value_col, first, keep)
    values = materialize(df.select(F.col(value_col).alias("__typed")).where("__typed is not null").distinct(), "values")
    parts = [materialize(map_values(values, "__typed", b, ["__typed"]).where("size(matches) > 0"), "matches") for b in chain([first, second], blocks)]
    found = reduce(DataFrame.unionByName, parts).select("__typed", F.explode("matches").alias("m"))
    found = found.groupBy("__typed").agg(F.array_sort(F.collect_list(F.struct("m.errors", "m.entry"))).alias("l"))
    found = found.select("__typed", F.transform("l", lambda x: F.struct(x["entry"].alias("entry"), x["errors"].alias("errors"))).alias("matches"))
    out = df.select(*keep, F.col(value_col).alias("__typed")).join(found, "__typed", "left")
    return out.select(*keep, F.coalesce("matches", F.array().cast(found.schema["matches"].dataType)).alias("matches"))
