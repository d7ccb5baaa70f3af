"""K3: the observation table loaded day by day, with stored partial aggregates.

A load replaces the days it brings (dynamic partition overwrite) and then derives
those days' rows of a small cube from the files just written: for each day, region
and category the row counts, and the sum and count of every measure. A day's cube
rows are bounded by regions times categories. The questions below add cube rows up;
they never read the observations, and equal a full rebuild.

Loading a day again replaces it, in both tables, so a corrected or repeated delivery
is right; after a crash between the two writes the same load is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from trendlens.operators.series import moving_average
from trendlens.operators.topk import top_k

DAY = "trending_date"
DIMENSIONS = ("region_code", "category_id", "category_name")
COUNTS = ("view_count", "likes", "dislikes", "comment_count")
MEASURES = (*COUNTS, "engagement")


def _exact_sum(name: str) -> Column:
    """The sum of a BIGINT column as DECIMAL(30,0): its high and low halves are added up
    as whole numbers, which is much cheaper for each row than adding decimals."""
    high, low = F.sum(F.shiftright(name, 32)), F.sum(F.col(name).bitwiseAND(F.lit(0xFFFFFFFF)))
    return (high.cast("decimal(20,0)") * F.lit(2**32).cast("decimal(10,0)") + low.cast("decimal(20,0)")).cast("decimal(30,0)")


def cube_rows(obs: DataFrame) -> DataFrame:
    """One row per (day, region, category): ``n_rows``, ``n_ids`` and for each measure
    ``<m>_sum`` and ``<m>_n``. Whole numbers add up exactly, whatever their size."""
    sums = []
    for m in MEASURES:
        sums += [(_exact_sum(m) if m in COUNTS else F.sum(m)).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n")]
    return obs.groupBy(DAY, *DIMENSIONS).agg(F.count("*").alias("n_rows"), F.count("video_id").alias("n_ids"), *sums)


class DailyTables:
    """``<root>/observations`` and ``<root>/cube``, partitioned by day."""

    def __init__(self, spark: SparkSession, root: str, files_per_day: int = 1):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files_per_day = files_per_day

    def _replace_days(self, df: DataFrame, path: str, files: int) -> None:
        spread = [F.pmod(F.xxhash64("video_id"), F.lit(files))] if files > 1 else []
        (df.repartition(DAY, *spread).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(DAY).parquet(path))

    def _days(self, name: str, days: list | None = None, schema: StructType | None = None) -> DataFrame:
        """A table, or only its folders of the given days."""
        path = f"{self.root}/{name}"
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        if days is None:
            return reader.option("basePath", path).parquet(path)
        folders = [f"{path}/{DAY}={'__HIVE_DEFAULT_PARTITION__' if d is None else d.isoformat()}" for d in days]
        return reader.option("basePath", path).parquet(*folders)

    def load(self, obs: DataFrame) -> list:
        """Replace the days that ``obs`` holds (observation columns); these days."""
        schema = StructType([*[f for f in obs.schema.fields if f.name != DAY], StructField(DAY, DateType())])
        # The input is computed once: it is written first, and its days are read off the files.
        staged = f"{self.root}/_staged"
        obs.write.mode("overwrite").parquet(staged)
        new = self.spark.read.schema(obs.schema).parquet(staged)
        days = sorted((r[0] for r in new.select(DAY).distinct().collect()), key=lambda d: (d is not None, d))
        if not days:
            return []
        self._replace_days(new, f"{self.root}/observations", self.files_per_day)
        self._replace_days(cube_rows(self._days("observations", days, schema)), f"{self.root}/cube", 1)
        return days

    def observations(self) -> DataFrame:
        return self._days("observations")

    def cube(self) -> DataFrame:
        return self._days("cube")


def _average(m: str) -> Column:
    return F.sum(f"{m}_sum").cast("double") / F.nullif(F.sum(f"{m}_n"), F.lit(0))


def popularity_over_time(cube: DataFrame, window_rows: int = 7) -> DataFrame:
    """A1 from the cube."""
    daily = cube.groupBy(DAY).agg(
        _average("view_count").alias("average_views"), F.sum("view_count_sum").try_cast("bigint").alias("total_views"),
        F.sum("n_ids").alias("video_count"))
    return moving_average(daily, "average_views", DAY, window_rows, name="moving_avg_7d").orderBy(DAY)


def top_categories(cube: DataFrame, k: int = 10) -> DataFrame:
    """A2 from the cube."""
    counts = cube.groupBy("category_id", "category_name").agg(F.sum("n_rows").alias("number_of_videos"))
    return top_k(counts, "number_of_videos", k, ["category_id", "category_name"])


def engagement_by_region(cube: DataFrame) -> DataFrame:
    """A6 from the cube."""
    return cube.groupBy("region_code").agg(
        _average("engagement").alias("average_engagement"), _average("likes").alias("average_likes"),
        _average("comment_count").alias("average_comments"), _average("view_count").alias("average_views")).orderBy(
        F.col("average_engagement").desc_nulls_last(), "region_code")


def avg_comments_per_category(cube: DataFrame, k: int = 20) -> DataFrame:
    """A10 from the cube."""
    avg = cube.groupBy("category_id", "category_name").agg(_average("comment_count").alias("average_comments"))
    return top_k(avg, "average_comments", k, ["category_id", "category_name"])


def trending_by_day_of_week(cube: DataFrame) -> DataFrame:
    """A11 from the cube."""
    return cube.groupBy(F.dayofweek(DAY).alias("day_of_week")).agg(
        F.sum("n_ids").alias("video_count"), _average("view_count").alias("average_views"),
        _average("likes").alias("average_likes"), _average("dislikes").alias("average_dislikes"),
        _average("comment_count").alias("average_comments"), _average("engagement").alias("average_engagement")).orderBy(
        "day_of_week")


QUESTIONS = {f.__name__: f for f in (popularity_over_time, top_categories, engagement_by_region, avg_comments_per_category,
                                     trending_by_day_of_week)}
