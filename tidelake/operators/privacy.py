"""Personal data in text: find, mask, replace by salted tokens; audit of jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: patterns without look-around and with ASCII classes only
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?[0-9]{1,2} \([0-9]{3}\) [0-9]{3}-[0-9]{4}",
    "vessel": r"IMO ?[0-9]{7}",
    "id_number": r"[0-9]{13,19}",
    "address": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
}

# text that every match of a kind contains; most texts lack it and need no pattern search
MARKS = {"email": "@", "phone": "(", "vessel": "IMO"}


def _searched(text: Column, kind: str, found: Column, otherwise: Column) -> Column:
    mark = MARKS.get(kind)
    return found if mark is None else F.when(F.contains(text, F.lit(mark)), found).otherwise(otherwise)


def count_pii(df: DataFrame, column: str, rules: dict[str, str] = PATTERNS) -> DataFrame:
    """Add the number of matches per kind."""
    text = F.col(column)
    counts = {
        f"n_{kind}": F.when(
            text.isNotNull(), _searched(text, kind, F.regexp_count(text, F.lit(pattern)), F.lit(0))
        )
        for kind, pattern in rules.items()
    }
    return df.withColumns(counts)


def mask_pii(df: DataFrame, column: str, rules: dict[str, str] = PATTERNS) -> DataFrame:
    """Replace each match by the name of its kind."""
    for kind, pattern in rules.items():
        text = F.col(column)
        masked = F.regexp_replace(text, pattern, f"[{kind.upper()}]")
        df = df.withColumn(column, _searched(text, kind, masked, text))
    return df


def edge_filter(df: DataFrame, column: str, rules: dict[str, str] = PATTERNS) -> DataFrame:
    """Before anything is stored: drop empty messages, mask the rest."""
    return mask_pii(df.filter(F.length(column) > 0), column, rules)


def _tokens(text: Column, kind: str, matches: Column, salt: str) -> Column:
    """Each distinct match becomes ``<kind:digest>``, the longest first so none cuts another.

    The whole digest: equal tokens stand for equal values.
    """
    ordered = F.array_sort(
        F.transform(F.array_distinct(matches), lambda m: F.struct((-F.length(m)).alias("n"), m.alias("m")))
    )

    def swap(done: Column, match: Column) -> Column:
        digest = F.sha2(F.concat(F.lit(salt), match["m"]).cast("binary"), 256)
        return F.replace(done, match["m"], F.concat(F.lit(f"<{kind}:"), digest, F.lit(">")))

    return F.aggregate(ordered, text, swap)


def anonymise(df: DataFrame, column: str, salt: str, rules: dict[str, str] = PATTERNS) -> DataFrame:
    """Replace each match by a salted token: equal values stay equal, none can be read back."""
    for kind, pattern in rules.items():
        text = F.col(column)
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        df = df.withColumn(column, _searched(text, kind, _tokens(text, kind, matches, salt), text))
    return df


def pseudonym(value: Column, salt: str) -> Column:
    """Salted digest of a whole value."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")).cast("binary"), 256)


def audit(df: DataFrame, job: str, actor: str, as_of: Column, by: list[str] | None = None) -> DataFrame:
    """Audit rows of a job: who, what, when and how many rows."""
    return df.groupBy(*(by or [])).agg(F.count("*").alias("rows")).select(
        F.lit(actor).alias("actor"), F.lit(job).alias("job"), as_of.alias("at"), *(by or []), "rows"
    )
