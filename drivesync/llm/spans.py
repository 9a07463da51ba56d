"""Places of matches in a text, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<start:int,end:int,hit:string>>"


def find(text: Column, pattern: str, guard: Column | None = None) -> Column:
    """Leftmost matches that don't overlap: start, end (code points, exclusive), text.

    What a split leaves between the matches gives their places. Where ``guard``
    is false there are none, and the text isn't searched.
    """
    pieces = F.filter(
        F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)),
        lambda x: x["0"].isNotNull())
    none = F.array().cast(SPANS)

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["1"])
        end = start + F.char_length(x["0"])
        hit = F.struct(start.alias("start"), end.alias("end"), x["0"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(hit)).alias("out"))

    found = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda state: state["out"])
    return F.when(text.rlike(pattern) if guard is None else guard, found).otherwise(none)


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(number)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(back)), F.lit(0),
        lambda sum_, i: sum_ + F.when(i % 2 == 1, F.substring(back, i, F.lit(1)).cast("int")).otherwise(
            F.pmod(F.substring(back, i, F.lit(1)).cast("int") * 2, F.lit(10)) + F.when(F.substring(back, i, F.lit(1)).cast("int") > 4, 1).otherwise(0)))
    return total % 10 == 0


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of structs with ``start, rank, end``, by start, then
    kind in the order of ``kinds``, joined by commas."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ",")
