"""One form for texts that look the same.

An Arrow batch of strings is handled as one array of code points. A lookup table gives each code
point's replacement: canonical decomposition, full- and half-width forms as their ordinary forms,
ligatures as letters, every space as U+0020, invisible signs as nothing, look-alike letters of other
scripts as the Latin letter. Replacements are gathered with expansion offsets, marks are put into
canonical order and composed by rank within their run, and line ends become U+000A. No step calls a
string function per row.

What looks different stays different: letter case, accents, superscripts, circled and styled signs.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

#: Letters of other scripts that look like the Latin letters below them (fixed values).
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνοϲϳ", "ABEZHIKMNOPTYXvocj")
CYRILLIC = ("АВЕЅІЈКМНОРСТХаеорсухѕіјһԁԛԝԚԜ", "ABESIJKMHOPCTXaeopcyxsijhdqwQW")
ARMENIAN = ("Օօսոհ", "Oounh")
CHEROKEE = ("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏚᎢᏙᏔᏃ", "ABCDEGHJKLMPSTVWZ")
#: Hyphens that look like U+002D, and signs that can't be seen.
HYPHENS = (0x2010, 0x2011)
INVISIBLE = (0x00AD, 0x034F, 0x061C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0x2066, 0x2070), *range(0xFE00, 0xFE10), 0xFEFF)
_TOP = 0x110000
_S, _L, _V, _T = 0xAC00, 0x1100, 0x1161, 0x11A7


class Tables:
    """Lookup tables, built once per process from the Unicode data of Python."""

    def __init__(self) -> None:
        like = {ord(a): b for x, y in (GREEK, CYRILLIC, ARMENIAN, CHEROKEE) for a, b in zip(x, y, strict=True)}
        like |= dict.fromkeys(HYPHENS, "-") | dict.fromkeys(INVISIBLE, "")
        special: dict[int, str] = {}

        def form(c: str) -> str:
            code = ord(c)
            if code in like:
                return like[code]
            d = unicodedata.decomposition(c)
            if d and not 0xAC00 <= code <= 0xD7A3:
                tag, _, rest = d.partition("> ") if d[0] == "<" else ("", "", d)
                ligature = 0xFB00 <= code <= 0xFB06
                if not tag or tag in ("<wide", "<narrow") or ligature:
                    return "".join(form(chr(int(x, 16))) for x in rest.split())
            if unicodedata.category(c) == "Zs" and code != 0x1680:
                return " "
            return c

        pairs: dict[tuple[int, int], int] = {}
        self.ccc = np.zeros(_TOP, np.uint8)
        for code in range(_TOP):
            if 0xD800 <= code < 0xE000:
                continue
            c = chr(code)
            f = form(c)
            if f != c:
                special[code] = f
            if cc := unicodedata.combining(c):
                self.ccc[code] = cc
            d = unicodedata.decomposition(c)
            if d and d[0] != "<" and " " in d and unicodedata.normalize("NFC", c) == c:
                a, b = (int(x, 16) for x in d.split())
                pairs[a, b] = code
        self.length = np.ones(_TOP, np.int64)
        self.first = np.zeros(_TOP, np.int64)
        pool: list[int] = []
        for code, f in special.items():
            self.length[code], self.first[code] = len(f), len(pool)
            pool += map(ord, f)
        self.pool = np.array(pool or [0], np.uint32)
        self.special = np.zeros(_TOP, bool)
        self.special[list(special)] = True
        keys = np.array([(a << 21) | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_to = keys[order], np.array(list(pairs.values()), np.uint32)[order]
        self.second = np.zeros(_TOP, bool)
        self.second[[b for _, b in pairs]] = True
        self.second |= self.ccc > 0

    def composed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The composite of each pair, 0 for none."""
        key = (a.astype(np.int64) << 21) | b.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        out = np.where(self.pair_keys[at] == key, self.pair_to[at], 0).astype(np.uint32)
        a, b = a.astype(np.int64), b.astype(np.int64)
        lv = (a >= _L) & (a < _L + 19) & (b >= _V) & (b < _V + 21)
        out = np.where(lv, _S + ((a - _L) * 21 + (b - _V)) * 28, out)
        lvt = (a >= _S) & (a < _S + 11172) & ((a - _S) % 28 == 0) & (b > _T) & (b < _T + 28)
        return np.where(lvt, a + (b - _T), out).astype(np.uint32)


_TABLES: Tables | None = None


def tables() -> Tables:
    global _TABLES
    if _TABLES is None:
        _TABLES = Tables()
    return _TABLES


def _drop(x: np.ndarray, gone: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the (ascending) positions `gone`."""
    return np.delete(x, gone), offsets - np.searchsorted(gone, offsets)


def normal_points(x: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normal form of rows x[offsets[i]:offsets[i+1]] of code points."""
    t = tables()
    if len(x) == 0:
        return x, offsets
    # line ends
    cr = x == 13
    if cr.any():
        at = np.flatnonzero(cr)
        inner = at[at + 1 < len(x)]
        pair = inner[(x[inner + 1] == 10) & ~np.isin(inner + 1, offsets)]
        x = x.copy()
        x[at] = 10
        x, offsets = _drop(x, pair, offsets)
    # gather replacements
    at = np.flatnonzero(x >= 0x80)
    at = at[t.special[x[at]]]
    if len(at):
        n = t.length[x[at]]
        shift = np.concatenate(([0], np.cumsum(n - 1)))
        new = at + shift[:-1]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        points = t.pool[np.repeat(t.first[x[at]], n) + inside]
        counts = np.ones(len(x), np.int64)
        counts[at] = n
        x = np.repeat(x, counts)
        x[np.repeat(new, n) + inside] = points
        offsets = offsets + shift[np.searchsorted(at, offsets)]
    at = np.flatnonzero(x >= 0x300)
    y = x[at]
    at = at[t.second[y] | ((y >= _V) & (y < _V + 21)) | ((y > _T) & (y < _T + 28))]
    at = at[~np.isin(at, offsets[:-1])]
    if not len(at):
        return x, offsets
    x = x.copy()
    # the run of each mark and its rank in the run
    new = np.concatenate(([True], np.diff(at) > 1))
    run = np.cumsum(new) - 1
    head = at[new] - 1  # the sign before each run
    # canonical order: sort by class within stretches that no sign of class 0 interrupts
    ccc = t.ccc[x[at]]
    stretch = np.cumsum((ccc == 0) | new)
    order = np.lexsort((np.arange(len(at)), ccc, stretch))
    x[at] = x[at][order]
    ccc = t.ccc[x[at]]
    rank = np.arange(len(at)) - np.flatnonzero(new)[run]
    base = head.copy()  # position of the last starter, by run
    last = np.zeros(len(head), np.int64)  # class of the last mark that stayed behind it; -1 blocks
    gone = np.zeros(len(x), bool)
    by_rank = np.argsort(rank, kind="stable")
    edges = np.searchsorted(rank[by_rank], np.arange(rank.max() + 2))
    for r in range(rank.max() + 1):
        k = by_rank[edges[r] : edges[r + 1]]
        i, g, c = at[k], run[k], ccc[k].astype(np.int64)
        free = (last[g] == 0) | ((last[g] < c) & (c > 0))
        both = np.where(free & (t.ccc[x[base[g]]] == 0), t.composed(x[base[g]], x[i]), 0)
        yes = both > 0
        x[base[g[yes]]] = both[yes]
        gone[i[yes]] = True
        stay, zero = ~yes & (c > 0), ~yes & (c == 0)
        last[g[stay]] = c[stay]
        base[g[zero]], last[g[zero]] = i[zero], 0
    return _drop(x, np.flatnonzero(gone), offsets)


def normalize_array(column: pa.Array) -> pa.Array:
    """The normal form of an Arrow string column; nulls stay null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    size = len(column)
    if size == 0:
        return column.cast(pa.string())
    _, offset_buf, data = column.buffers()
    off = np.frombuffer(offset_buf, np.int64)[column.offset : column.offset + size + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.empty(0, np.uint8)
    off = off - off[0]
    odd = (raw >= 0x80) | (raw == 13)
    if not odd.any():
        return column.cast(pa.string())
    # rows of plain signs are their own form
    seen = np.concatenate(([0], np.cumsum(odd)))
    some = seen[off[1:]] > seen[off[:-1]]
    if some.mean() < 0.7:
        part = normalize_array(column.filter(pa.array(some)))
        kind = pa.large_string() if pa.types.is_large_string(part.type) else pa.string()
        return pa.compute.replace_with_mask(column.cast(kind), pa.array(some), part)
    inner = np.flatnonzero((raw & 0xC0) == 0x80)
    try:
        x = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
        offsets = off - np.searchsorted(inner, off)
    except UnicodeDecodeError:  # bytes that aren't UTF-8 become U+FFFD; the row borders must hold
        rows = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:], strict=True)]
        x = np.frombuffer("".join(rows).encode("utf-32-le"), "<u4")
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    x, offsets = normal_points(x.astype(np.uint32), offsets)
    wide = np.flatnonzero(x >= 0x80)
    y = x[wide]
    extra = np.concatenate(([0], np.cumsum(1 + (y >= 0x800).astype(np.int64) + (y >= 0x10000))))
    out = x.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    valid = pa.compute.is_valid(column)
    bits = pa.array(valid.to_numpy(zero_copy_only=False).astype(np.uint8), pa.uint8()).cast(pa.bool_()).buffers()[1]
    bytes_off = offsets + extra[np.searchsorted(wide, offsets)]
    if bytes_off[-1] > np.iinfo(np.int32).max:
        return pa.LargeStringArray.from_buffers(size, pa.py_buffer(bytes_off.astype(np.int64).tobytes()), pa.py_buffer(out), bits)
    return pa.StringArray.from_buffers(size, pa.py_buffer(bytes_off.astype(np.int32).tobytes()), pa.py_buffer(out), bits)


def normal_form(df: DataFrame, text_col: str, keep: list[str], out_col: str = "form") -> DataFrame:
    """`keep` columns and the text's normal form. A narrow map.

    Nulls stay null, empty texts empty; a text of invisible signs becomes empty; a combining mark
    at the start of a text stays; the form of a form is the form itself.
    """
    src = df.select(*keep, df[text_col].alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], normalize_array(b.column(b.num_columns - 1))], [*keep, out_col])

    return src.mapInArrow(run, f"{schema}, `{out_col}` string")


if sys.maxunicode < 0x10FFFF:  # pragma: no cover
    raise ImportError("needs full Unicode")
