"""Text as columns: words, shingles and places, by built-in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything but ASCII letters, ASCII digits and characters beyond ASCII parts words.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else. `lower` does the same where all characters are ASCII, and faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text in order; none for null or a text without any."""
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def rolling(array: Column, size: Column, k: int) -> Column:
    """One struct (w0 .. w{k-1}) for each place; the last k - 1 are filled up with nulls."""
    parts = [array, *(F.slice(array, i + 1, size) for i in range(1, k))]
    return F.arrays_zip(*(part.alias(f"w{i}") for i, part in enumerate(parts)))


def places(text: Column, pattern: str, kind: str, good, score) -> Column:
    """Matches of `pattern`, leftmost and non-overlapping, as (kind, start, end, score) in code points.

    `good(match)` keeps a match; `score(match, around)` rates it, `around` being the forty characters on
    either side in lower case. The text is cut at its matches, so the lengths of the parts give the places.
    """
    entry = "struct<kind:string,start:bigint,end:bigint,score:double>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        around = F.lower(F.concat(
            F.substr(text, F.greatest(start - 39, F.lit(1)), F.least(start, F.lit(40))), F.lit(" "),
            F.substr(text, end + 1, F.lit(40)),
        ))
        here = F.struct(
            F.lit(kind).alias("kind"), start.cast("long").alias("start"), end.cast("long").alias("end"),
            score(part["hit"], around).cast("double").alias("score"),
        )
        return F.struct(
            end.alias("at"),
            F.when(good(part["hit"]), F.concat(state["out"], F.array(here))).otherwise(state["out"]).alias("out"),
        )

    empty = F.expr(f"cast(array() as array<{entry}>)")
    return F.aggregate(
        F.arrays_zip(gaps.alias("gap"), found.alias("hit")),
        F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda state: state["out"],
    )


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
