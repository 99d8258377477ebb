"""The document functions as Arrow-based Spark functions, by column and by SQL name."""

from __future__ import annotations

from functools import cache

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..schemas import BOUNDARY
from . import markup, slicing, tables


def _text(convert):
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(convert)

    return run


def html_to_md(column, drop_comments: bool = False):
    return _text(lambda s: markup.html_to_md(s, drop_comments))(column)


def tables_to_md(column):
    return _text(tables.tables_to_md)(column)


def fold_text(column):
    """Accent- and case-folded text without marks; null stays null."""
    return _text(lambda s: None if s is None else slicing.fold(s).text)(column)


@cache
def _blocks():
    @F.pandas_udf("array<struct<kind:string,text:string>>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: [{"kind": k, "text": t} for k, t in markup.html_blocks(s)])

    return run


@cache
def _lines():
    @F.pandas_udf("array<struct<pos:bigint,start:bigint,leads:boolean,line:string>>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: None if s is None else [dict(zip(("pos", "start", "leads", "line"), row, strict=True)) for row in slicing.Lines(s).table()])

    return run


@cache
def _located():
    @F.pandas_udf(BOUNDARY)
    def run(texts: pd.Series, titles: pd.Series, following: pd.Series) -> pd.DataFrame:
        rows = [slicing.boundaries(a or "", b, c) for a, b, c in zip(texts, titles, following, strict=True)]
        out = pd.DataFrame(rows, columns=list(slicing.Boundaries._fields))
        out["end"] = out["end"].astype("Int64")
        return out

    return run


def _cutter(min_confidence: float = slicing.MIN_CONFIDENCE, min_longest: int = 0):
    @F.pandas_udf("string")
    def run(texts: pd.Series, titles: pd.Series, following: pd.Series) -> pd.Series:
        return pd.Series([slicing.cut_note(a, b, c, min_confidence, min_longest) for a, b, c in zip(texts, titles, following, strict=True)], dtype=object)

    return run


def html_blocks(column):
    """array<struct<kind, text>>, for posexplode."""
    return _blocks()(column)


def text_lines(column):
    """array<struct<pos, start, leads, line>> of a text's lines, for inline(); leads: blank lines and headings."""
    return _lines()(column)


def locate_title(text, title, following):
    """Boundaries of a note in a page-level text, as a struct."""
    return _located()(text, title, following)


def cut_note(text, title, following, min_confidence: float = slicing.MIN_CONFIDENCE, min_longest: int = 0):
    return _cutter(min_confidence, min_longest)(text, title, following)


def register(spark: SparkSession) -> None:
    """All of them for SQL, under the same names."""
    functions = {
        "html_to_md": _text(markup.html_to_md),
        "tables_to_md": _text(tables.tables_to_md),
        "fold_text": _text(lambda s: None if s is None else slicing.fold(s).text),
        "html_blocks": _blocks(),
        "text_lines": _lines(),
        "locate_title": _located(),
        "cut_note": _cutter(),
    }
    for name, function in functions.items():
        spark.udf.register(name, function)
