"""Keyword search over the sale-detail table with paging and shares.

One filtered DataFrame (all-terms keyword match, optional day) feeds three
small queries: total, page and stats. Results are per day (``dt``), so a single run answers the
request for every day at once; ``date=`` restricts to one day and prunes the
day partitions of a stored table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.constants import (AGE_BUCKETS, BAND_20_TO_30, BAND_30_PLUS, BAND_UNDER_20,
                                GENDER_BUCKETS, GENDER_NAMES)
from shopflow.functions.numeric import age_band, remainder_pct, share_pct
from shopflow.functions.text import matches_all_terms
from shopflow.operators.topk import page, top_buckets

STAT_AGE, STAT_GENDER = "age", "gender"   # stat titles (page reads stat[0], stat[1])


def search(sale: DataFrame, keyword: str, date: str | None = None) -> DataFrame:
    """FLT8/FLT9: rows whose ``sku_name`` contains every keyword term."""
    hits = sale
    if date is not None:
        hits = hits.filter(F.col("dt") == date)
    return hits.filter(matches_all_terms(F.col("sku_name"), keyword))


def search_total(hits: DataFrame) -> DataFrame:
    """AGG12: total hits per day."""
    return hits.groupBy("dt").agg(F.count(F.lit(1)).alias("total"))


def search_page(hits: DataFrame, page_no: int, size: int) -> DataFrame:
    """PRJ19/LIM2: one page of hits in (day, line id) order."""
    return page(hits, [F.col("dt"), F.col("order_detail_id")], page_no, size)


def facets(hits: DataFrame, terms: tuple[str, ...] = ("user_age", "user_gender")) -> DataFrame:
    """Hit counts per ``(dt, *terms)``. A share query groups by its own term
    only; ``search_stats`` groups once by age and gender, and both stats start
    from the same exchange of these counts, so the hits (scan + joins +
    keyword filter) are evaluated once per request."""
    return hits.groupBy("dt", *terms).agg(F.count(F.lit(1)).alias("doc_count"))


def _counts(f: DataFrame, term: str) -> DataFrame:
    """Counts per day and term, with the day's ``total`` (NULL terms included);
    the window sees one row per day and term."""
    return (f.groupBy("dt", term).agg(F.sum("doc_count").alias("doc_count"))
            .withColumn("total", F.sum("doc_count").over(Window.partitionBy("dt"))))


def gender_share(hits: DataFrame, f: DataFrame | None = None) -> DataFrame:
    """AGG9/AGG16: the two biggest gender buckets per day and their share of
    the day's hits. Output ``dt, user_gender, doc_count, share``."""
    f = facets(hits, ("user_gender",)) if f is None else f
    return (top_buckets(_counts(f, "user_gender"), "user_gender", GENDER_BUCKETS, ["dt"])
            .select("dt", "user_gender", "doc_count",
                    share_pct(F.col("doc_count"), F.col("total")).alias("share")))


def age_terms(hits: DataFrame, f: DataFrame | None = None) -> DataFrame:
    """AGG10: the 100 biggest age buckets per day."""
    f = facets(hits, ("user_age",)) if f is None else f
    return (top_buckets(_counts(f, "user_age"), "user_age", AGE_BUCKETS, ["dt"])
            .select("dt", "user_age", "doc_count"))


def age_band_share(hits: DataFrame, f: DataFrame | None = None) -> DataFrame:
    """AGG11/PRJ17/PRJ18: share of hits under 20, 20-29 and the remainder
    (30 and over, plus ages outside the top-100 buckets), per day.
    Output ``dt, name, value`` (three rows per day)."""
    f = facets(hits, ("user_age",)) if f is None else f
    age = F.col("user_age")
    # buckets by size, the NULL bucket after all others: only the top ones count
    by_size = Window.partitionBy("dt").orderBy(age.isNull(), F.desc("doc_count"), age)
    top = age.isNotNull() & (F.col("rank") <= AGE_BUCKETS)
    shares = (_counts(f, "user_age").withColumn("rank", F.row_number().over(by_size))
              .withColumn("band", F.when(top, age_band(age)))
              .groupBy("dt").agg(
                  F.sum(F.when(F.col("band") == BAND_UNDER_20, F.col("doc_count")).otherwise(0)).alias("n20"),
                  F.sum(F.when(F.col("band") == BAND_20_TO_30, F.col("doc_count")).otherwise(0)).alias("n30"),
                  F.max("total").alias("total"))
              .select("dt", share_pct(F.col("n20"), F.col("total")).alias("a"),
                      share_pct(F.col("n30"), F.col("total")).alias("b")))
    options = F.array(
        F.struct(F.lit(BAND_UNDER_20).alias("name"), F.col("a").alias("value")),
        F.struct(F.lit(BAND_20_TO_30).alias("name"), F.col("b").alias("value")),
        F.struct(F.lit(BAND_30_PLUS).alias("name"),
                 remainder_pct(F.col("a"), F.col("b")).alias("value")))
    return shares.select("dt", F.explode(options).alias("o")).select("dt", "o.name", "o.value")


TOTAL, BY_AGE, BY_GENDER = 3, 1, 2   # grouping ids of (user_age, user_gender)


def cube(hits: DataFrame) -> DataFrame:
    """AGG9/10/12/16 in one aggregate over the hits: grouping sets for the
    day's total, its ages and its genders. ``dt, user_age, user_gender,
    doc_count, part`` (which of the three)."""
    return (hits.select("dt", "user_age", "user_gender")
            .groupingSets([["dt"], ["dt", "user_age"], ["dt", "user_gender"]], "dt", "user_age", "user_gender")
            .agg(F.count(F.lit(1)).alias("doc_count"),
                 F.grouping_id("dt", "user_age", "user_gender").alias("part")))


def search_stats(hits: DataFrame) -> DataFrame:
    """Search-page payload: per day two ``Stat`` rows -- ``stat[0]`` age bands,
    ``stat[1]`` gender shares -- each with ``options`` = [(name, value)].
    One aggregate over the hits (``cube``) and one exchange of its rows by day:
    a day has its total, at most as many age rows as there are ages, and its
    genders; ranks, shares and bands come from windows over these."""
    term = F.coalesce(F.col("user_age").cast("string"), F.col("user_gender"))
    day = Window.partitionBy("dt")
    biggest = Window.partitionBy("dt", "part").orderBy(term.isNull(), F.desc("doc_count"), "user_age", "user_gender")
    rows = (cube(hits).withColumn("rank", F.row_number().over(biggest))
            .withColumn("total", F.max(F.when(F.col("part") == TOTAL, F.col("doc_count"))).over(day)))
    counted = term.isNotNull()

    def in_band(name: str) -> Column:
        inside = (F.col("part") == BY_AGE) & counted & (F.col("rank") <= AGE_BUCKETS) & (age_band(F.col("user_age")) == name)
        return F.sum(F.when(inside, F.col("doc_count")).otherwise(0))
    names = F.col("user_gender")
    for code, label in GENDER_NAMES.items():
        names = F.when(F.col("user_gender") == code, F.lit(label)).otherwise(names)
    shown = F.when((F.col("part") == BY_GENDER) & counted & (F.col("rank") <= GENDER_BUCKETS), F.struct(
        # biggest bucket first, as the terms aggregation returns them
        (-F.col("doc_count")).alias("ord"), names.alias("name"),
        share_pct(F.col("doc_count"), F.col("total")).alias("value")))
    per_day = rows.groupBy("dt").agg(
        in_band(BAND_UNDER_20).alias("n20"), in_band(BAND_20_TO_30).alias("n30"),
        F.max("total").alias("total"), F.array_sort(F.collect_list(shown)).alias("genders"))
    a, b = share_pct(F.col("n20"), F.col("total")), share_pct(F.col("n30"), F.col("total"))

    def option(name: Column, value: Column) -> Column:
        return F.struct(name.alias("name"), value.alias("value"))
    ages = F.array(option(F.lit(BAND_UNDER_20), a), option(F.lit(BAND_20_TO_30), b),
                   option(F.lit(BAND_30_PLUS), remainder_pct(a, b)))
    genders = F.transform("genders", lambda g: option(g["name"], g["value"]))
    # a day without a gender has no gender stat
    stats = F.array(F.struct(F.lit(0).alias("idx"), F.lit(STAT_AGE).alias("title"), ages.alias("options")),
                    F.struct(F.lit(1).alias("idx"), F.lit(STAT_GENDER).alias("title"), genders.alias("options")))
    return (per_day.select("dt", F.explode(stats).alias("s")).select("dt", "s.idx", "s.title", "s.options")
            .filter(F.size("options") > 0))
