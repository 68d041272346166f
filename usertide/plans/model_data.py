"""Model table: join of features and label, encoding, scaling and the stratified split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usertide.operators.checks import assert_unique
from usertide.schema import numeric_columns, quoted, require_columns, text_columns
from usertide.session import materialize

HASH_BITS = 48
# Bits of the hash key that one pass of the split looks at.
STEP_BITS = 16


def join_label(features: DataFrame, labels: DataFrame, compat: bool = False, check_keys: bool = True) -> DataFrame:
    """Features with churn_30d, for the users in both tables.

    ``last_active_date`` goes, as it lies after the label window.  ``signup_date`` goes too unless
    ``compat`` keeps it as text, in which case it is encoded by day and leaks the label.
    """
    require_columns(features, ["user_id"], "features")
    require_columns(labels, ["user_id", "churn_30d"], "labels")
    if check_keys:
        assert_unique(features, "user_id", "features")
        assert_unique(labels, "user_id", "labels")
    joined = features.join(labels.select("user_id", F.col("churn_30d").cast("int").alias("churn_30d")), "user_id")
    joined = joined.drop("last_active_date")
    if "signup_date" not in joined.columns:
        return joined
    if compat:
        return joined.withColumn("signup_date", F.to_date("signup_date").cast("string"))
    return joined.drop("signup_date")


def split_key(id_col: str, seed: int) -> Column:
    """A repeatable 48-bit number per id."""
    digest = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def stratified_split(
    df: DataFrame, label: str = "churn_30d", id_col: str = "user_id", test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split``: exactly round(test_share x n) rows of each label are 'test', the rest 'train'.

    The rows with the smallest hash keys are the test rows.  Three passes of counts per label and key
    prefix find the key of each label's last test row, 16 bits at a time; only rows that share this very
    key are ordered, by id.  The cuts are a table with a row per label that the rows then join, so any
    number of labels will do.  ``df`` is best a stored table: it is read five times.
    """
    keyed = df.select(
        F.col(quoted(label)).alias("__label"), F.col(quoted(id_col)).alias("__id"), split_key(quoted(id_col), seed).alias("__key")
    )
    sizes = keyed.groupBy("__label").agg(F.count(F.lit(1)).alias("__n"))
    wanted = F.round(F.col("__n") * F.lit(test_share)).cast("bigint").alias("__place")
    # A row per label whose next test row is looked for among the keys that begin with __prefix.
    found = materialize(sizes.select(F.col("__label").alias("__of"), F.lit(0).cast("bigint").alias("__prefix"), wanted).filter("__place > 0"))
    for bits in range(0, HASH_BITS, STEP_BITS):
        here = (F.col("__label").eqNullSafe(F.col("__of"))) & (F.shiftright("__key", HASH_BITS - bits) == F.col("__prefix"))
        counts = (
            keyed.join(found, here)
            .groupBy("__of", "__place", F.shiftright("__key", HASH_BITS - bits - STEP_BITS).alias("__next"))
            .agg(F.count(F.lit(1)).alias("__n"))
        )
        # At most 65,536 rows per label.
        before = Window.partitionBy("__of").orderBy("__next").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        last = (F.col("__before") < F.col("__place")) & (F.col("__place") <= F.col("__before") + F.col("__n"))
        found = materialize(
            placed.filter(last).select("__of", F.col("__next").alias("__prefix"), (F.col("__place") - F.col("__before")).alias("__place"))
        )
    same = keyed.join(found, F.col("__label").eqNullSafe(F.col("__of")) & (F.col("__key") == F.col("__prefix")))
    position = F.row_number().over(Window.partitionBy("__of").orderBy("__id"))
    cuts = materialize(
        same.withColumn("__position", position)
        .filter("__position = __place")
        .select("__of", F.col("__key").alias("__cut"), F.col("__id").alias("__cut_id"))
    )
    key = split_key(quoted(id_col), seed)
    in_test = (key < F.col("__cut")) | ((key == F.col("__cut")) & (F.col(quoted(id_col)) <= F.col("__cut_id")))
    joined = df.drop("split").join(cuts, F.col(quoted(label)).eqNullSafe(F.col("__of")), "left")
    return joined.withColumn("split", F.when(in_test, "test").otherwise("train")).drop("__of", "__cut", "__cut_id")


def class_weights(df: DataFrame, label: str = "churn_30d") -> DataFrame:
    """One row per label: n and the balanced weight rows / (labels x n)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per label reaches this window.
    every = Window.partitionBy(F.lit(0))
    total, labels = F.sum("n").over(every), F.count(F.lit(1)).over(every)
    return counts.select(label, "n", (total / (labels * F.col("n"))).alias("weight"))


def fit_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The values of each category column, sorted; one pass for all columns.

    Levels become columns, so they pass through the driver; a column of free text is no category.
    """
    if not columns:
        return {}
    found = (
        df.select(*[quoted(c) for c in columns])
        .unpivot([], [quoted(c) for c in columns], "column", "level")
        .filter(F.col("level").isNotNull())
        .distinct()
        .collect()
    )
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in found:
        levels[row["column"]].append(row["level"])
    for values in levels.values():
        values.sort()
    return levels


def dummy_columns(levels: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """One 0/1 column per level but the first; a null gives all zeros."""
    return {
        f"{c}_{level}": F.when(F.col(quoted(c)) == level, 1.0).otherwise(0.0)
        for c, values in levels.items()
        for level in list(values)[1:]
    }


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, the latter 1 where it is 0."""
    if not columns:
        return {}
    row = df.agg(
        *[F.avg(quoted(c)).alias(f"mean_{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(quoted(c)).alias(f"std_{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"mean_{i}"] or 0.0, row[f"std_{i}"] or 1.0) for i, c in enumerate(columns)}


def scaled_columns(scaler: Mapping[str, tuple[float, float]]) -> dict[str, Column]:
    return {c: (F.col(quoted(c)).cast("double") - F.lit(mean)) / F.lit(std) for c, (mean, std) in scaler.items()}


@dataclass(frozen=True)
class Encoding:
    """Fitted levels and scaling of a model table."""

    levels: dict[str, list[str]]
    scaler: dict[str, tuple[float, float]]

    @property
    def features(self) -> list[str]:
        return [*self.scaler, *dummy_columns(self.levels)]

    def columns(self) -> dict[str, Column]:
        return {**scaled_columns(self.scaler), **dummy_columns(self.levels)}

    def apply(self, df: DataFrame, keep: Sequence[str] = ("user_id", "churn_30d", "split")) -> DataFrame:
        """The encoded features beside the ``keep`` columns that exist."""
        kept = [c for c in keep if c in df.columns]
        return df.select(*kept, *[c.alias(name) for name, c in self.columns().items()])


def fit_encoding(df: DataFrame, not_features: Sequence[str] = ("user_id", "churn_30d", "split")) -> Encoding:
    """Levels and scaling of all text and numeric columns; fit on training rows to keep test rows unseen."""
    return Encoding(
        fit_levels(df, text_columns(df, not_features)), fit_scaler(df, numeric_columns(df, not_features))
    )


def prepare_model_data(
    features: DataFrame, labels: DataFrame, compat: bool = False, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Joined, unencoded model table with ``split``.

    Features, labels and their join are stored, as the key checks and the split read each of them
    more than once.
    """
    joined = materialize(join_label(materialize(features), materialize(labels), compat))
    return stratified_split(joined, test_share=test_share, seed=seed)


def encoded_tables(data: DataFrame, compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """Encoded train and test rows of a prepared table: id, label and features.

    Levels and scaling are fitted on the training rows; ``compat`` fits them on all rows.
    """
    train, test = data.filter("split = 'train'"), data.filter("split = 'test'")
    encoding = fit_encoding(data if compat else train)
    return encoding.apply(train, ("user_id", "churn_30d")), encoding.apply(test, ("user_id", "churn_30d"))
