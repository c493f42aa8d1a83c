"""Summary statistics of a table and their text report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tickerforge.operators.returns import numeric_columns


#: Size of a sketch, how far from a wanted rank (as a share of the rows) a bracket reaches, twice the sketch's error, and parts that what lies between is cut into.
SKETCH, TRUST, PARTS = 4096, 0.0025, 4096


def quantiles(values: DataFrame, ps: tuple[float, ...]) -> DataFrame:
    """(field, p, value): exact interpolated quantiles of each field of (field, x), in two scans of the values.

    The first makes a mergeable sketch of each field, which gives a bracket of values around each wanted rank; the
    brackets, a row for each field and p, are all that comes to the driver. The second counts what is below a bracket
    and the single values in it, half a hundredth of the rows. The counts prove that the bracket holds its ranks;
    should one not, its quantile is counted over the whole range in place of it. No task holds a field or a bracket:
    brackets are cut into parts, and only those that hold a wanted rank are put in order.
    """
    sketched = values.groupBy("field").agg(F.kll_sketch_agg_double("x", F.lit(SKETCH)).alias("_k"), F.count("x").alias("total"), F.min("x").alias("least"), F.max("x").alias("most"))
    few = F.col("total") * TRUST < 4  # the whole range, where ranks are farther apart than that

    def bracket(p: float) -> Column:
        low = F.col("least") if p <= TRUST else F.when(few, F.col("least")).otherwise(F.kll_sketch_get_quantile_double("_k", F.lit(p - TRUST)))
        high = F.col("most") if p >= 1 - TRUST else F.when(few, F.col("most")).otherwise(F.kll_sketch_get_quantile_double("_k", F.lit(p + TRUST)))
        return F.struct(F.lit(p).alias("p"), F.col("total"), low.alias("lo"), high.alias("hi"), F.col("least"), F.col("most"))

    known = sketched.select("field", F.inline(F.array(*[bracket(float(p)) for p in ps]))).collect()
    near = values.sparkSession.createDataFrame(known, "field string, p double, total long, lo double, hi double, least double, most double")
    found = _within(values, near.drop("least", "most"))
    rest = near.join(F.broadcast(found.select("field", "p")), ["field", "p"], "left_anti")
    return found.unionByName(_within(values, rest.select("field", "p", "total", F.col("least").alias("lo"), F.col("most").alias("hi"))))


def _within(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """The quantiles (field, p, value) whose ranks lie in their brackets (field, p, total, lo, hi)."""
    x, wide, keys = F.col("x"), F.col("hi") - F.col("lo"), ["field", "p", "total"]
    part = F.when(x < F.col("lo"), -1).when((wide > 0) & (wide < float("inf")), F.least(F.floor((x - F.col("lo")) / wide * PARTS), F.lit(PARTS))).otherwise(0).cast("int")
    met = values.join(F.broadcast(brackets), "field").where(x <= F.col("hi")).withColumn("part", part)
    counts = met.groupBy(*keys, "part", F.when(F.col("part") >= 0, x).alias("x")).agg(F.count(F.lit(1)).alias("n"))

    def ranked(frame: DataFrame, within: list[str], order: str) -> DataFrame:
        return frame.withColumn("_upto", F.sum("n").over(Window.partitionBy(*within).orderBy(order)))

    at = F.col("p") * (F.col("total") - 1)
    sides = F.array(F.struct(F.lit("lo").alias("side"), F.floor(at).alias("rank")), F.struct(F.lit("hi").alias("side"), F.ceil(at).alias("rank")))
    hit = (F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("n"))
    parts = ranked(counts.groupBy(*keys, "part").agg(F.sum("n").alias("n")), keys, "part").select("*", F.inline(sides)).where(hit & (F.col("part") >= 0))
    wanted = parts.select(*keys, "part", "side", (F.col("rank") - F.col("_upto") + F.col("n")).alias("rank"))
    inside = counts.join(F.broadcast(wanted.select(*keys, "part").distinct()), [*keys, "part"])
    single = ranked(inside, [*keys, "part"], "x").join(F.broadcast(wanted), [*keys, "part"]).where(hit)
    one = single.groupBy("field", "p", (at - F.floor(at)).alias("_share")).agg(F.max(F.when(F.col("side") == "lo", x)).alias("_a"), F.max(F.when(F.col("side") == "hi", x)).alias("_b"))
    a, b = F.col("_a"), F.col("_b")
    return one.where(a.isNotNull() & b.isNotNull()).select("field", "p", F.when(a == b, a).otherwise(a + (b - a) * F.col("_share")).alias("value"))


def summary(frame: DataFrame, date: str = "date") -> DataFrame:
    """One row per numeric column: count of rows, first and last date, least, quartiles, mean and largest.

    Nulls and NaN are left out; quartiles are interpolated. An empty table gives no rows.
    """
    columns = numeric_columns(frame, besides=())
    if not columns:
        return frame.sparkSession.createDataFrame([], "field string, n long, min_date date, max_date date, min double, p25 double, median double, mean double, p75 double, max double")
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    dates = [F.min(date).alias("_a"), F.max(date).alias("_b")] if date in frame.columns else [F.lit(None).cast("date").alias("_a"), F.lit(None).cast("date").alias("_b")]
    per = [F.struct(F.lit(c).alias("field"), F.min(x).alias("min"), F.avg(x).alias("mean"), F.max(x).alias("max")) for c, x in clean.items()]
    one = frame.agg(F.count(F.lit(1)).alias("n"), *dates, F.array(*per).alias("_s")).where("n > 0")
    s = one.select("n", "_a", "_b", F.explode("_s").alias("s")).select("n", "_a", "_b", "s.*")
    values = frame.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), x.alias("x")) for c, x in clean.items()])).alias("_v")).select("_v.*").where("x IS NOT NULL")
    q = quantiles(values, (0.25, 0.5, 0.75))
    wide = q.groupBy(F.col("field").alias("_f")).agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in ((0.25, "p25"), (0.5, "median"), (0.75, "p75"))])
    found = s.join(F.broadcast(wide), F.col("field") == F.col("_f"), "left")  # a row for each column
    return found.select("field", "n", F.col("_a").alias("min_date"), F.col("_b").alias("max_date"), "min", "p25", "median", "mean", "p75", "max")


def report(rows: list[Row], precision: int = 4) -> str:
    """The statistics as text for a terminal."""
    if not rows:
        return "No data"
    head = [f"Observations: {rows[0]['n']}"]
    if rows[0]["min_date"] is not None:
        head.append(f"Dates: {rows[0]['min_date']} to {rows[0]['max_date']}")
    names = ("min", "p25", "median", "mean", "p75", "max")
    body = [f"{r['field']}: " + ", ".join(f"{n} {'-' if r[n] is None else format(r[n], f'.{precision}f')}" for n in names) for r in rows]
    return "\n".join([*head, *body])
