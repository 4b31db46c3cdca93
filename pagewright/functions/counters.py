"""Token counters: the heuristic one, and an exact one by a local vocabulary.

The heuristic counter is additive over joined texts, so that packing folds over unit counts inside the JVM. An exact
counter isn't: packing by it joins the pieces of a section and counts anew (`pack_exactly`), in one Arrow-fed
group per section.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as T

_LOADED: dict[str, Callable[[str], int]] = {}


def load_counter(path: str) -> Callable[[str], int]:
    """Counts tokens by the vocabulary file at `path` (tokenizer.json, without special tokens), once per process."""
    if path not in _LOADED:
        from tokenizers import Tokenizer

        if not os.path.isfile(path):
            raise FileNotFoundError(path)
        t = Tokenizer.from_file(path)
        t.no_padding()
        t.no_truncation()
        _LOADED[path] = lambda s: len(t.encode(s, add_special_tokens=False).ids)
    return _LOADED[path]


@dataclass(frozen=True)
class Counter:
    """A chosen counter; `exact` says whether it counts by a vocabulary. The file must be readable by all executors."""

    path: str | None = None

    @property
    def exact(self) -> bool:
        return self.path is not None

    def count(self, text: Column) -> Column:
        """Tokens of a text, as an int column; null for null."""
        if self.path is None:
            return T.token_count(text)
        path = self.path

        @F.pandas_udf("int")
        def exact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            n = load_counter(path)
            for b in batches:
                yield b.map(lambda s: None if s is None else n(s)).astype("Int32")

        return exact(text)


def choose_counter(path: str | None) -> Counter:
    """The exact counter of a vocabulary file, else, with a warning, the heuristic one."""
    if not path:
        return Counter()
    try:
        load_counter(path)
        return Counter(path)
    except Exception as e:  # noqa: BLE001 - any fault of the file or the library means estimates
        logging.getLogger(__name__).warning("token counts are estimates: %s: %s", type(e).__name__, e)
        return Counter()


def pack_exactly(df: DataFrame, keys: list[str], ord_col: str, target: int, counter: Counter, text: str = "text", sep: str = "\n\n") -> DataFrame:
    """(keys, ord, grp): greedy packing of each section's pieces while their joined text has at most `target` tokens;
    a larger piece stands alone. One section is one group: the texts of a section meet in one task."""
    path = counter.path
    src = df.select(*keys, ord_col, F.coalesce(F.col(text), F.lit("")).alias("__t"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]) + ", grp int"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n = load_counter(path) if path else heuristic_count
        pdf = pdf.sort_values(ord_col, kind="stable") if not isinstance(pdf[ord_col].iloc[0], dict) else pdf.loc[sorted(pdf.index, key=lambda i: tuple(pdf.at[i, ord_col].values()))]
        grp, held, out = -1, None, []
        for t in pdf["__t"]:
            if held is not None and n(joined := held + sep + t) <= target:
                held = joined
            else:
                grp, held = grp + 1, t
            out.append(grp)
        return pdf[[*keys, ord_col]].assign(grp=out)

    return src.groupBy(*keys).applyInPandas(run, schema)


def heuristic_count(text: str) -> int:
    """The heuristic count of one text in Python."""
    import re

    return int(len(re.findall(r"\w+|[^\w\s]", text)) * 1.3) + 1
