"""Data-quality checks: each returns the violating rows (empty = pass); ``Watch`` counts them while rows are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hazeframe.operators.dedup import final


def out_of_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    c, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return df.filter(bad)


def duplicate_keys(df: DataFrame, keys: list[str], row_filter=None) -> DataFrame:
    rows = df if row_filter is None else df.filter(row_filter)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).filter(F.col("duplicate_count") > 1)


def duplicate_keys_final(df: DataFrame, keys: list[str], version_keys: list[str], version: str,
                         row_filter=None) -> DataFrame:
    """Duplicates that remain after collapsing to the latest version."""
    return duplicate_keys(final(df, version_keys, version), keys, row_filter)


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def not_unique(df: DataFrame, column: str) -> DataFrame:
    return duplicate_keys(df, [column], F.col(column).isNotNull())


def not_accepted(df: DataFrame, column: str, values) -> DataFrame:
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n")))


def not_between(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(~F.col(column).between(low, high))


def row_rules(required: list[str] = (), accepted: dict[str, list] | None = None, between: dict[str, tuple] | None = None) -> dict[str, Column]:
    """Name of a rule on single rows -> what breaks it."""
    rules = {f"required {c}": F.col(c).isNull() for c in required}
    rules |= {f"accepted {c}": F.col(c).isNotNull() & ~F.col(c).isin(list(v)) for c, v in (accepted or {}).items()}
    return rules | {f"between {c}": ~F.col(c).between(*v) for c, v in (between or {}).items()}


def contract(df: DataFrame, model: str, required: list[str] = (), key: list[str] = (), accepted: dict[str, list] | None = None,
             between: dict[str, tuple] | None = None) -> DataFrame:
    """``model, check, violations`` of the rules declared for a model; a null breaks only ``required``.

    The rules on single rows are counted in one pass; the key needs a grouping
    of its own, whose violations are the surplus rows.
    """
    rules, found = row_rules(required, accepted, between), []
    if rules:
        counts = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
        found.append(counts.select(F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"`{name}`").alias("violations")) for name in rules])).alias("c")).select("c.*"))
    if key:
        twice = duplicate_keys(df, list(key)).agg(F.coalesce(F.sum(F.col("duplicate_count") - 1), F.lit(0)).alias("violations"))
        found.append(twice.select(F.lit("unique " + " ".join(key)).alias("check"), "violations"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(F.lit(model).alias("model"), "check", "violations")


class ContractBroken(ValueError):
    """Rows that were to be stored break the rules of their model."""


class Watch:
    """The rules of ``contract``, counted by the job that writes the rows, and judged before they replace anything.

    The rules on single rows, and the share of rows for which ``ok`` holds, come
    from the write itself; only a ``key`` needs a grouping afterwards, over its
    own columns of what was written.  ``strict`` raises ``ContractBroken`` when a
    rule is broken; otherwise the counts are kept and the rows stored.  A share
    below ``minimum`` counts all rows that are not ``ok`` as violations; no rows
    break nothing.  A watch serves one write after the other.
    """

    def __init__(self, model: str, required: list[str] = (), key: list[str] = (), accepted: dict[str, list] | None = None,
                 between: dict[str, tuple] | None = None, ok: Column | None = None, minimum: float = 0.90, strict: bool = True):
        self.model, self.key, self.ok, self.minimum, self.strict = model, list(key), ok, minimum, strict
        self.rules = row_rules(required, accepted, between)
        self.rows, self.violations = 0, {}

    def attach(self, df: DataFrame) -> DataFrame:
        """``df``, counted as it is written: the write must follow without a shuffle in between."""
        self._seen = Observation()
        hit = F.lit(True) if self.ok is None else F.coalesce(self.ok, F.lit(False))
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"), F.count_if(hit).alias("succeeded"),
                          *[F.count_if(bad).alias(name) for name, bad in self.rules.items()])

    def settle(self, written: DataFrame) -> None:
        """Judge the rows that the observed job wrote."""
        seen = self._seen.get
        self.rows = seen["rows"]
        self.violations = {name: seen[name] for name in self.rules}
        if self.key:
            twice = duplicate_keys(written, self.key).agg(F.coalesce(F.sum(F.col("duplicate_count") - 1), F.lit(0))).first()[0]
            self.violations["unique " + " ".join(self.key)] = twice
        if self.ok is not None:
            failed = self.rows - seen["succeeded"]
            self.violations["success share"] = failed if seen["succeeded"] < self.minimum * self.rows else 0
        broken = {name: n for name, n in self.violations.items() if n}
        if broken and self.strict:
            raise ContractBroken(f"{self.model}: " + ", ".join(f"{name}: {n} of {self.rows} rows" for name, n in broken.items()))

    def report(self, spark: SparkSession) -> DataFrame:
        """``model, check, violations`` of the last write: a row per rule."""
        return spark.createDataFrame([(self.model, name, n) for name, n in self.violations.items()], "model string, check string, violations long")


def freshness(df: DataFrame, ts: str, as_of, warn_hours: int = 6, error_hours: int = 12, by: list[str] = ()) -> DataFrame:
    """Latest timestamp against ``as_of``: pass / warn / error."""
    out = df.groupBy(*by).agg(F.max(ts).alias("latest"))
    age = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("latest")
    return out.withColumns({
        "age_seconds": age,
        "status": F.when(F.col("latest").isNull() | (age > error_hours * 3600), "error")
                   .when(age > warn_hours * 3600, "warn").otherwise("pass")})
