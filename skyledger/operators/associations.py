"""Charts and the coded routes they show: by identifier, by review, and for titles of two parallel runways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.aviation import approach_ident, chart_title

RULES = ("canonical", "reviewed", "parallel-equivalent", "parallel-choice", "unmatched")


def parallel_titles(title: Column) -> Column:
    """The two titles that one of parallel runways stands for ('... RWY 13L/R'), else null."""
    parts = [F.regexp_extract(chart_title(title), r"^(.* RWY \d{2})([LCR])/([LCR])$", k) for k in (1, 2, 3)]
    return F.when((parts[0] != "") & (parts[1] != parts[2]), F.array(F.concat(parts[0], parts[1]), F.concat(parts[0], parts[2])))


def associate(charts: DataFrame, routes: DataFrame, reviews: DataFrame, content: list[str]) -> DataFrame:
    """(chart, route_ids, status, rule): the routes that each chart shows, each chart once.

    ``charts`` (chart, airport, title, plate), ``routes`` (route, airport, ident and the columns ``content``, nested ones
    too), ``reviews`` (airport, title, route, plate). In turn: routes of the title's identifier at the airport; the route a
    review names, if the review's plate is the chart's (in any case of letters) and exactly one route has that name; for a
    title of two runways, if each has exactly one route, the first of them where both agree in all ``content``, as
    values, else both as a choice. One route is matched, several are ambiguous, none is unmatched. Reviews of one chart
    that name different routes count as none.

    Routes are counted and gathered by airport and identifier before charts meet them, so charts never multiply."""
    c = F.col
    values = F.struct(*[c(x) for x in content])
    by_ident = routes.where("airport is not null and ident is not null").groupBy("airport", "ident").agg(F.array_sort(F.collect_list("route")).alias("ids"), F.first(values).alias("content"))
    two = parallel_titles(c("title"))
    asked = charts.select("chart", "airport", "plate", chart_title(c("title")).alias("title"), approach_ident(c("title")).alias("ident"), *[approach_ident(two[i]).alias(f"ident_{i}") for i in (0, 1)])

    def looked_up(df: DataFrame, ident: str, name: str) -> DataFrame:
        side = by_ident.select("airport", c("ident").alias(ident), c("ids").alias(name), c("content").alias(f"{name}_content"))
        return df.join(side, ["airport", ident], "left")

    found = looked_up(looked_up(looked_up(asked, "ident", "own"), "ident_0", "first"), "ident_1", "second")
    named = routes.groupBy("airport", "route").agg(F.count("*").alias("same"))
    review = reviews.select("airport", chart_title(c("title")).alias("title"), "route", F.upper("plate").alias("reviewed_plate")).distinct().join(named, ["airport", "route"], "left")
    review = review.groupBy("airport", "title").agg(F.count("*").alias("reviews"), F.min("route").alias("reviewed"), F.min("reviewed_plate").alias("reviewed_plate"), F.min("same").alias("same"))
    found = found.join(review, ["airport", "title"], "left")
    seen = (c("reviews") == 1) & (c("same") == 1) & (c("reviewed_plate") == F.upper("plate"))
    single = (F.size("first") == 1) & (F.size("second") == 1)
    rule = (
        F.when(c("own").isNotNull(), RULES[0]).when(F.coalesce(seen, F.lit(False)), RULES[1])
        .when(F.coalesce(single & c("first_content").eqNullSafe(c("second_content")), F.lit(False)), RULES[2]).when(F.coalesce(single, F.lit(False)), RULES[3]).otherwise(RULES[4])
    )
    none = F.array().cast(by_ident.schema["ids"].dataType)
    picked = found.withColumn("rule", rule)
    ids = F.when(c("rule") == RULES[0], c("own")).when(c("rule") == RULES[1], F.array("reviewed")).when(c("rule") == RULES[2], c("first")).when(c("rule") == RULES[3], F.concat("first", "second")).otherwise(none)
    status = F.when(F.size("route_ids") == 0, "unmatched").when(F.size("route_ids") == 1, "matched").otherwise("ambiguous")
    return picked.select("chart", ids.alias("route_ids"), "rule").select("chart", "route_ids", status.alias("status"), "rule")
