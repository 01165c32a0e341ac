"""Column helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.session import new_scratch

# ASCII white space: what separates words and what is stripped from lines
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def isolate(df: DataFrame, **named: str) -> DataFrame:
    """The columns an operator works on under its own names, and all other columns as `_row`.

    Internal names start with an underscore after this, so the input's other columns cannot
    clash with them, whatever they are called.
    """
    others = [df[c].alias(c) for c in df.columns if c not in named.values()]
    row = F.struct(*others) if others else F.lit(None).cast("boolean")
    return df.select(*[df[source].alias(f"_{name}") for name, source in named.items()], row.alias("_row"))


def restore(df: DataFrame, columns: Sequence[str], named: dict[str, str], **results: Column) -> DataFrame:
    """The input's columns again, with `results` added; a result replaces a column of its name.

    `named` gives the columns outside `_row` as isolate() took them: {"doc": "doc_id"}.
    """
    # results get their names last: in one select they could be taken for a column named by an alias
    done = df.select("_row", *[f"_{name}" for name in named], *[v.alias(f"_out_{name}") for name, v in results.items()])
    back = {source: done[f"_{name}"] for name, source in named.items()}
    kept = [back.get(c, done["_row"][c]).alias(c) for c in columns if c not in results]
    return done.select(*kept, *[done[f"_out_{name}"].alias(name) for name in results])


def hash128(value: Column) -> list[Column]:
    """Two independent 64-bit hashes: together wide enough that no corpus has a collision."""
    return [F.xxhash64(value), F.xxhash64(F.lit("second"), value)]


def settle(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a checkpoint in the shared folder; a lost executor costs no recomputation.

    Folder: what the session names in spark.checkpoint.dir, or one of the library's own where it is unset.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(new_scratch(df.sparkSession, "checkpoints"))
    return df.checkpoint()
