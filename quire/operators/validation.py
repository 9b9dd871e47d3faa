"""Validation rules over chunks, and the bounded correction loop."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import non_empty


@dataclass(frozen=True)
class Rule:
    """A rule for one region type (None: all). ``test`` gives a Column from a column getter."""

    name: str
    kind: str | None
    test: Callable[[Callable[[str], Column]], Column]
    hint: str


def _row_counts(col) -> Column:
    headers, rows = col("headers"), col("rows")
    filled = (F.coalesce(F.size(headers), F.lit(0)) > 0) & (F.coalesce(F.size(rows), F.lit(0)) > 0)
    return ~filled | F.forall(rows, lambda r: F.size(r) == F.size(headers))


# Hints and the correction request.
RULES = (
    Rule("row_column_count", "table", _row_counts, "Each data row must have exactly the same number of columns as the headers list. If a cell is empty, use an empty string."),
    Rule("latex_present", "formula", lambda col: non_empty(col("latex")), "Return the formula as LaTeX in the 'latex' field. Do not leave it empty or missing."),
    Rule("overview_present", None, lambda col: non_empty(col("overview")), "Include a 1-2 sentence plain-English description of this region in the 'overview' field."),
)
REQUEST = "The previous response did not satisfy the following requirements. Re-extract and fix only the issues listed below:"


def failing(kind: Column, col: Callable[[str], Column], rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that apply to the type and don't hold, in their order."""
    tests = [F.when(((kind == r.kind) if r.kind else F.lit(True)) & ~F.coalesce(r.test(col), F.lit(False)), r.name) for r in rules]
    return F.filter(F.array(*tests), lambda n: n.isNotNull())


def correction_prompt(prompt: Column, names: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    hints = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.hint)])
    lines = F.transform(names, lambda n: F.concat(F.lit("CORRECTION REQUIRED ("), n, F.lit("): "), F.element_at(hints, n)))
    return F.concat(prompt, F.lit(f"\n\n{REQUEST}\n\n"), F.array_join(lines, "\n"))


def validate_and_correct(chunks: DataFrame, call: Callable[[DataFrame], DataFrame], rules: tuple[Rule, ...] = RULES, max_passes: int = 2, write: Callable[[DataFrame], DataFrame] | None = None, fill: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Check answers and ask again, at most ``max_passes`` times, for those that fail.

    ``chunks``: chunk_id, content_type, prompt, raw_text and answer; ``call`` adds answer to rows that lack
    it; ``write`` (default: a written table in the shared folder) fixes answers that may differ when computed
    again. Adds correction_applied, confidence_score (1, or 0 where rules still fail) and passes.

    ``fill`` puts answers into the chunks before they are written, so that the answers themselves, with their
    copies of the text, aren't; what was asked is kept beside it only where it is asked again.
    """
    from quire.operators.extraction import PARSED, with_parsed
    from quire.operators.stores import write_and_read

    write = write or write_and_read

    def checked(rows: DataFrame) -> DataFrame:
        rows = with_parsed(rows)
        rows = rows.withColumn("failed", failing(F.col("content_type"), lambda n: F.col("__a")[n], rules))
        return rows.drop(*PARSED) if fill is None else fill(rows.withColumn("__asked", F.when(F.size("failed") > 0, F.struct(*asked))))

    asked = [c for c in chunks.columns if c != "answer"] + ["passes"]

    rows = write(checked(chunks.withColumn("passes", F.lit(0))))
    done = rows.where(F.size("failed") == 0)
    for n in range(1, max_passes + 1):
        open_ = rows.where(F.size("failed") > 0)
        open_ = open_ if fill is None else open_.select("__asked.*", "failed")
        again = open_.withColumn("__prompt", F.col("prompt")).withColumn("prompt", correction_prompt(F.col("prompt"), F.col("failed"), rules)).drop(*(c for c in ("answer", "failed") if c in open_.columns))
        again = call(again).withColumn("prompt", F.col("__prompt")).drop("__prompt").withColumn("passes", F.lit(n))
        rows = write(checked(again))
        done = done.unionByName(rows.where(F.size("failed") == 0) if n < max_passes else rows)
    ok = F.size("failed") == 0
    done = done.drop("__asked")
    return done.withColumn("correction_applied", F.col("passes") > 0).withColumn("confidence_score", F.when(ok, 1.0).otherwise(0.0))


def corrections(validated: DataFrame) -> DataFrame:
    """(region_type, pass_number, n): how many chunks each pass was made for."""
    return validated.where("passes > 0").select(F.col("content_type").alias("region_type"), F.explode(F.sequence(F.lit(1), F.col("passes"))).alias("pass_number")).groupBy("region_type", "pass_number").agg(F.count("*").alias("n"))
