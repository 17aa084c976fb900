"""Saved analyst questions over the dimensional and aggregate tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.catalog import query
from tierflow.catalog.sqltext import r
from tierflow.functions.columns import calendar_date, ratio, rounded
from tierflow.plans import domain, layers

# Parameter values of the questions, chosen from the value lists of the given tables.
FRANCHISE, REGION, GENRE, TITLE_ID = "Brand#12", "EUROPE", "ECONOMY", 7


def usd(name="total_gross_usd"):
    return rounded(name, 2).alias(name)


@query(
    "vq1_top_franchises",
    f"""SELECT franchise, genre, title_count, {r('total_gross_usd', 2)} AS total_gross_usd, total_streams
    FROM agg_franchise ORDER BY agg_franchise.total_gross_usd DESC, franchise, genre LIMIT 5""",
)
def vq1(t):
    top = layers.agg_franchise(t).orderBy(F.desc("total_gross_usd"), "franchise", "genre").limit(5)
    return top.select("franchise", "genre", "title_count", usd(), "total_streams")


@query(
    "vq2_engagement_by_region",
    f"""SELECT region, account_type, fan_count, {r('avg_interactions', 4)} AS avg_interactions,
    {r('avg_titles_engaged', 4)} AS avg_titles_engaged FROM agg_fan_value ORDER BY fan_count DESC""",
)
def vq2(t):
    return layers.agg_fan_value(t).select(
        "region", "account_type", "fan_count",
        rounded("avg_interactions", 4).alias("avg_interactions"),
        rounded("avg_titles_engaged", 4).alias("avg_titles_engaged"),
    ).orderBy(F.desc("fan_count"))


def since_last(t, shift):
    """The start of a period that ends with the newest report date: one value, read before the query is built."""
    return layers.last_report_date(t).select(shift(F.col("d"))).first()[0]


def fact_with_titles(t, *columns, since=None):
    dim = layers.dim_titles(t).select("title_id", *columns)
    return layers.fact_daily(t, since).join(dim, "title_id")


@query(
    "vq3_revenue_per_title",
    f"""SELECT title_name, franchise, genre, {r('sum(total_gross_usd)', 2)} AS total_revenue,
    CAST(sum(total_tickets_sold) AS BIGINT) AS total_tickets, CAST(sum(stream_count) AS BIGINT) AS total_streams
    FROM fact JOIN dim_titles USING (title_id) GROUP BY title_name, franchise, genre""",
)
def vq3(t):
    totals = fact_with_titles(t, "title_name", "franchise", "genre").groupBy("title_name", "franchise", "genre").agg(
        rounded(F.sum("total_gross_usd"), 2).alias("total_revenue"),
        F.sum("total_tickets_sold").alias("total_tickets"),
        F.sum("stream_count").alias("total_streams"),
    )
    return totals.orderBy(F.desc("total_revenue"))


@query(
    "vq4_daily_regional_trend",
    f"""SELECT report_date, region, {r('sum(total_gross_usd)', 2)} AS daily_gross,
    CAST(sum(total_tickets_sold) AS BIGINT) AS daily_tickets, CAST(sum(unique_fans) AS BIGINT) AS daily_fans
    FROM fact GROUP BY report_date, region""",
)
def vq4(t):
    daily = layers.fact_daily(t).groupBy("report_date", "region").agg(
        rounded(F.sum("total_gross_usd"), 2).alias("daily_gross"),
        F.sum("total_tickets_sold").alias("daily_tickets"),
        F.sum("unique_fans").alias("daily_fans"),
    )
    return daily.orderBy(F.desc("report_date"), F.desc("daily_gross"))


@query(
    "vq5_most_engaged_fans",
    """SELECT first_name, last_name, region, account_type, lifetime_interactions, titles_engaged, preferred_device
    FROM dim_fans ORDER BY lifetime_interactions DESC, fan_id LIMIT 10""",
)
def vq5(t):
    top = layers.dim_fans(t).orderBy(F.desc("lifetime_interactions"), "fan_id").limit(10)
    return top.select(
        "first_name", "last_name", "region", "account_type", "lifetime_interactions", "titles_engaged", "preferred_device"
    )


@query(
    "vq6_ticket_price_by_title_region",
    f"""SELECT title_name, region, {r('avg(avg_ticket_price_usd)', 3)} AS avg_ticket_price,
    CAST(sum(theater_count) AS BIGINT) AS total_theaters
    FROM fact JOIN dim_titles USING (title_id) GROUP BY title_name, region""",
)
def vq6(t):
    prices = fact_with_titles(t, "title_name").groupBy("title_name", "region").agg(
        rounded(F.avg("avg_ticket_price_usd"), 3).alias("avg_ticket_price"),
        F.sum("theater_count").alias("total_theaters"),
    )
    return prices.orderBy(F.desc("avg_ticket_price"))


@query(
    "vq7_signups_by_month",
    f"""SELECT CAST(date_trunc('month', signup_date) AS DATE) AS signup_month, account_type, count(*) AS new_fans,
    {r('avg(lifetime_interactions)', 4)} AS avg_interactions FROM dim_fans GROUP BY 1, 2""",
)
def vq7(t):
    signups = layers.dim_fans(t).groupBy(calendar_date("signup_date", "month").alias("signup_month"), "account_type")
    return signups.agg(
        F.count("*").alias("new_fans"), rounded(F.avg("lifetime_interactions"), 4).alias("avg_interactions")
    ).orderBy(F.desc("signup_month"))


@query(
    "vq8_recently_active_countries",
    """SELECT country_code, account_type, active_last_30_days, active_last_7_days, top_device
    FROM agg_fan_value WHERE active_last_30_days > 0""",
)
def vq8(t):
    active = layers.agg_fan_value(t).where(F.col("active_last_30_days") > 0)
    return active.select(
        "country_code", "account_type", "active_last_30_days", "active_last_7_days", "top_device"
    ).orderBy(F.desc("active_last_30_days"))


@query(
    "vq9_catalog_by_genre_rating",
    f"""SELECT genre, rating, count(*) AS title_count, {r('avg(imdb_score)', 4)} AS avg_imdb_score,
    {r('avg(runtime_minutes)', 4)} AS avg_runtime, {r('sum(budget_usd)', 2)} AS total_budget
    FROM dim_titles GROUP BY genre, rating""",
)
def vq9(t):
    catalog = layers.dim_titles(t).groupBy("genre", "rating").agg(
        F.count("*").alias("title_count"),
        rounded(F.avg("imdb_score"), 4).alias("avg_imdb_score"),
        rounded(F.avg("runtime_minutes"), 4).alias("avg_runtime"),
        rounded(F.sum("budget_usd"), 2).alias("total_budget"),
    )
    return catalog.orderBy(F.desc("title_count"))


@query(
    "vq10_streaming_vs_theatrical",
    f"""SELECT franchise, genre, total_tickets, {r('total_gross_usd', 2)} AS theatrical_gross, total_streams,
    total_unique_fans, {r('CAST(total_gross_usd AS DOUBLE) / nullif(CAST(total_tickets AS DOUBLE), 0)', 2)} AS revenue_per_ticket
    FROM agg_franchise""",
)
def vq10(t):
    return layers.agg_franchise(t).select(
        "franchise", "genre", "total_tickets",
        rounded("total_gross_usd", 2).alias("theatrical_gross"),
        "total_streams", "total_unique_fans",
        rounded(ratio("total_gross_usd", "total_tickets"), 2).alias("revenue_per_ticket"),
    ).orderBy(F.desc("theatrical_gross"))


@query(
    "sq1_franchise_ranking",
    f"SELECT franchise, genre, {r('total_gross_usd', 2)} AS total_revenue, total_tickets, title_count FROM agg_franchise",
)
def sq1(t):
    return layers.agg_franchise(t).select(
        "franchise", "genre", rounded("total_gross_usd", 2).alias("total_revenue"), "total_tickets", "title_count"
    ).orderBy(F.desc("total_revenue"))


@query(
    "sq2_active_fans_by_region",
    """SELECT region, CAST(sum(active_last_30_days) AS BIGINT) AS monthly_active_fans,
    CAST(sum(fan_count) AS BIGINT) AS total_fans FROM agg_fan_value GROUP BY region""",
)
def sq2(t):
    return layers.agg_fan_value(t).groupBy("region").agg(
        F.sum("active_last_30_days").alias("monthly_active_fans"), F.sum("fan_count").alias("total_fans")
    ).orderBy(F.desc("monthly_active_fans"))


@query(
    "sq3_top_rated_by_genre",
    "SELECT genre, title_name, imdb_score, release_year FROM dim_titles WHERE imdb_score IS NOT NULL",
)
def sq3(t):
    rated = layers.dim_titles(t).where(F.col("imdb_score").isNotNull())
    return rated.select("genre", "title_name", "imdb_score", "release_year").orderBy("genre", F.desc("imdb_score"))


@query(
    "sq4_revenue_last_30_days",
    f"""SELECT report_date, {r('sum(total_gross_usd)', 2)} AS daily_revenue,
    CAST(sum(total_tickets_sold) AS BIGINT) AS daily_tickets FROM fact
    WHERE report_date >= (SELECT max(report_date) FROM fact) - 30 GROUP BY report_date""",
)
def sq4(t):
    recent = layers.fact_daily(t, since_last(t, lambda d: F.date_sub(d, 30)))
    return recent.groupBy("report_date").agg(
        rounded(F.sum("total_gross_usd"), 2).alias("daily_revenue"), F.sum("total_tickets_sold").alias("daily_tickets")
    ).orderBy("report_date")


@query(
    "sq5_engagement_by_account_type",
    f"""SELECT account_type, CAST(sum(fan_count) AS BIGINT) AS total_fans, {r('avg(avg_interactions)', 4)} AS avg_engagement,
    {r('avg(avg_titles_engaged)', 4)} AS avg_content_consumed FROM agg_fan_value GROUP BY account_type""",
)
def sq5(t):
    return layers.agg_fan_value(t).groupBy("account_type").agg(
        F.sum("fan_count").alias("total_fans"),
        rounded(F.avg("avg_interactions"), 4).alias("avg_engagement"),
        rounded(F.avg("avg_titles_engaged"), 4).alias("avg_content_consumed"),
    )


@query(
    "sq6_revenue_by_franchise",
    f"SELECT franchise, {r('sum(total_gross_usd)', 2)} AS total_revenue FROM agg_franchise GROUP BY franchise",
)
def sq6(t):
    return layers.agg_franchise(t).groupBy("franchise").agg(
        rounded(F.sum("total_gross_usd"), 2).alias("total_revenue")
    ).orderBy(F.desc("total_revenue"))


@query(
    "sq7_fans_by_region",
    "SELECT region, CAST(sum(fan_count) AS BIGINT) AS total_fans FROM agg_fan_value GROUP BY region",
)
def sq7(t):
    return layers.agg_fan_value(t).groupBy("region").agg(F.sum("fan_count").alias("total_fans")).orderBy(F.desc("total_fans"))


@query(
    "sq8_top_five_rated",
    """SELECT title_name, imdb_score, franchise, release_year FROM dim_titles WHERE imdb_score IS NOT NULL
    ORDER BY imdb_score DESC, title_id LIMIT 5""",
)
def sq8(t):
    rated = layers.dim_titles(t).where(F.col("imdb_score").isNotNull())
    return rated.orderBy(F.desc("imdb_score"), "title_id").limit(5).select(
        "title_name", "imdb_score", "franchise", "release_year"
    )


@query(
    "eq1_top_franchises_full",
    f"""SELECT franchise, genre, title_count, {r('total_gross_usd', 2)} AS total_gross_usd, total_tickets, total_streams
    FROM agg_franchise ORDER BY agg_franchise.total_gross_usd DESC, franchise, genre LIMIT 5""",
)
def eq1(t):
    top = layers.agg_franchise(t).orderBy(F.desc("total_gross_usd"), "franchise", "genre").limit(5)
    return top.select("franchise", "genre", "title_count", usd(), "total_tickets", "total_streams")


@query(
    "eq2_engagement_with_activity",
    f"""SELECT region, account_type, fan_count, {r('avg_interactions', 4)} AS avg_interactions,
    {r('avg_titles_engaged', 4)} AS avg_titles_engaged, active_last_30_days FROM agg_fan_value""",
)
def eq2(t):
    return layers.agg_fan_value(t).select(
        "region", "account_type", "fan_count",
        rounded("avg_interactions", 4).alias("avg_interactions"),
        rounded("avg_titles_engaged", 4).alias("avg_titles_engaged"),
        "active_last_30_days",
    ).orderBy(F.desc("fan_count"))


@query(
    "eq3_top_rated_titles",
    """SELECT title_name, franchise, release_year, imdb_score, CAST(budget_usd AS DOUBLE) AS budget_usd, rating
    FROM dim_titles WHERE imdb_score IS NOT NULL ORDER BY imdb_score DESC, title_id LIMIT 10""",
)
def eq3(t):
    rated = layers.dim_titles(t).where(F.col("imdb_score").isNotNull())
    return rated.orderBy(F.desc("imdb_score"), "title_id").limit(10).select(
        "title_name", "franchise", "release_year", "imdb_score", F.col("budget_usd").cast("double").alias("budget_usd"), "rating"
    )


@query(
    "eq4_last_week_performance",
    f"""SELECT title_id, region, report_date, total_tickets_sold, {r('total_gross_usd', 2)} AS total_gross_usd, stream_count
    FROM fact WHERE report_date >= (SELECT max(report_date) FROM fact) - 7
    ORDER BY report_date DESC, fact.total_gross_usd DESC, title_id, region LIMIT 20""",
)
def eq4(t):
    recent = layers.fact_daily(t, since_last(t, lambda d: F.date_sub(d, 7)))
    top = recent.orderBy(F.desc("report_date"), F.desc("total_gross_usd"), "title_id", "region").limit(20)
    return top.select("title_id", "region", "report_date", "total_tickets_sold", usd(), "stream_count")


@query(
    "fq1_one_franchise",
    f"""SELECT franchise, genre, {r('total_gross_usd', 2)} AS total_gross_usd, total_tickets FROM agg_franchise
    WHERE franchise = '{FRANCHISE}'""",
)
def fq1(t):
    return layers.agg_franchise(t).where(F.col("franchise") == FRANCHISE).select("franchise", "genre", usd(), "total_tickets")


@query(
    "fq2_one_region_fans",
    f"SELECT region, country_code, fan_count, active_last_30_days FROM agg_fan_value WHERE region = '{REGION}'",
)
def fq2(t):
    return layers.agg_fan_value(t).where(F.col("region") == REGION).select(
        "region", "country_code", "fan_count", "active_last_30_days"
    )


@query(
    "fq3_last_three_months",
    f"""SELECT title_id, region, report_date, {r('total_gross_usd', 2)} AS total_gross_usd, total_tickets_sold FROM fact
    WHERE report_date >= CAST((SELECT max(report_date) FROM fact) - INTERVAL 3 MONTH AS DATE)""",
)
def fq3(t):
    recent = layers.fact_daily(t, since_last(t, lambda d: F.add_months(d, -3)))
    return recent.select("title_id", "region", "report_date", usd(), "total_tickets_sold")


@query(
    "fq4_one_genre_titles",
    f"SELECT title_name, franchise, genre, imdb_score, release_year FROM dim_titles WHERE genre = '{GENRE}'",
)
def fq4(t):
    return layers.dim_titles(t).where(F.col("genre") == GENRE).select(
        "title_name", "franchise", "genre", "imdb_score", "release_year"
    )


@query(
    "fq5_verified_fans",
    """SELECT account_type, region, country_code, lifetime_interactions FROM dim_fans WHERE account_type = 'VERIFIED'""",
)
def fq5(t):
    return layers.dim_fans(t).where(F.col("account_type") == "VERIFIED").select(
        "account_type", "region", "country_code", "lifetime_interactions"
    )


@query(
    "gq1_quarter_leaderboard",
    f"""SELECT franchise, {r('sum(f.total_gross_usd)', 2)} AS total_global_box_office
    FROM fact f JOIN dim_titles t ON f.title_id = t.title_id
    WHERE report_date >= date_trunc('quarter', (SELECT max(report_date) FROM fact)) GROUP BY franchise""",
)
def gq1(t):
    quarter = since_last(t, lambda d: F.trunc(d, "quarter"))
    return fact_with_titles(t, "franchise", since=quarter).groupBy("franchise").agg(
        rounded(F.sum("total_gross_usd"), 2).alias("total_global_box_office")
    ).orderBy(F.desc("total_global_box_office"))


@query(
    "gq2_back_catalogue",
    f"""SELECT title_name, release_year, imdb_score FROM dim_titles WHERE genre = '{GENRE}' AND release_year < 1999
    ORDER BY imdb_score DESC NULLS LAST, title_id LIMIT 10""",
)
def gq2(t):
    old = layers.dim_titles(t).where((F.col("genre") == GENRE) & (F.col("release_year") < 1999))
    return old.orderBy(F.desc_nulls_last("imdb_score"), "title_id").limit(10).select("title_name", "release_year", "imdb_score")


@query(
    "gq3_super_fans_by_region",
    """SELECT region, count(DISTINCT fan_id) AS active_verified_fans FROM dim_fans
    WHERE account_type = 'VERIFIED' AND lifetime_interactions >= (SELECT avg(lifetime_interactions) FROM dim_fans)
    GROUP BY region""",
)
def gq3(t):
    fans = layers.dim_fans(t)
    mean = fans.agg(F.avg("lifetime_interactions").alias("m")).scalar()
    top = fans.where((F.col("account_type") == "VERIFIED") & (F.col("lifetime_interactions") >= mean))
    return top.groupBy("region").agg(F.countDistinct("fan_id").alias("active_verified_fans"))


@query(
    "gq4_one_title_day_over_day",
    f"""SELECT report_date, {r('sum(total_gross_usd)', 2)} AS gross_usd FROM fact
    WHERE title_id = (SELECT min(title_id) FROM dim_titles WHERE title_id = {TITLE_ID}) GROUP BY report_date""",
)
def gq4(t):
    chosen = layers.dim_titles(t).where(F.col("title_id") == TITLE_ID).agg(F.min("title_id").alias("id")).scalar()
    return layers.fact_daily(t, title=chosen).groupBy("report_date").agg(
        rounded(F.sum("total_gross_usd"), 2).alias("gross_usd")
    ).orderBy("report_date")


@query(
    "gq5_opening_roi",
    f"""SELECT title_name, CAST(budget_usd AS DOUBLE) AS marketing_budget, {r('sum(total_gross_usd)', 2)} AS opening_gross,
    {r('CAST(sum(total_gross_usd) AS DOUBLE) / nullif(CAST(budget_usd AS DOUBLE), 0) * 100', 2)} AS roi_percentage
    FROM fact f JOIN dim_titles t ON f.title_id = t.title_id
    WHERE report_date BETWEEN release_date AND release_date + 2 GROUP BY title_name, budget_usd""",
)
def gq5(t):
    opening = fact_with_titles(t, "title_name", "budget_usd", "release_date").where(
        F.col("report_date").between(F.col("release_date"), F.date_add("release_date", 2))
    )
    return opening.groupBy("title_name", "budget_usd").agg(F.sum("total_gross_usd").alias("gross")).select(
        "title_name",
        F.col("budget_usd").cast("double").alias("marketing_budget"),
        rounded("gross", 2).alias("opening_gross"),
        rounded(ratio("gross", "budget_usd") * 100, 2).alias("roi_percentage"),
    )


@query(
    "gq6_fan_affinity",
    f"""SELECT title_name, count(DISTINCT fan_id) AS shared_viewers FROM fans JOIN dim_titles USING (title_id)
    WHERE event_type = 'STREAM' AND title_id <> {TITLE_ID}
      AND fan_id IN (SELECT fan_id FROM fans WHERE event_type = 'STREAM' AND title_id = {TITLE_ID})
    GROUP BY title_name ORDER BY shared_viewers DESC, title_name LIMIT 5""",
)
def gq6(t):
    watched = domain.fan_activity(t).where((F.col("event_type") == "STREAM") & F.col("fan_id").isNotNull())
    watched = watched.select("fan_id", "title_id")
    viewers = watched.where(F.col("title_id") == TITLE_ID).select("fan_id").distinct()
    shared = watched.where(F.col("title_id") != TITLE_ID).join(viewers, "fan_id", "left_semi")
    named = shared.join(domain.small_titles(t).select("title_id", "title_name"), "title_id")
    return named.groupBy("title_name").agg(F.countDistinct("fan_id").alias("shared_viewers")).orderBy(
        F.desc("shared_viewers"), "title_name"
    ).limit(5)


@query(
    "gq7_director_sentiment",
    f"""SELECT director, title_name, release_year, {r('CAST(sum(value) AS DOUBLE) / count(*)', 4)} AS avg_fan_sentiment
    FROM fans JOIN dim_titles USING (title_id) WHERE director = 'Director 3' GROUP BY 1, 2, 3""",
)
def gq7(t):
    films = domain.small_titles(t).where(F.col("director") == "Director 3").select(
        "title_id", "director", "title_name", "release_year"
    )
    return domain.fan_activity(t).join(films, "title_id").groupBy("director", "title_name", "release_year").agg(
        rounded(ratio(F.sum("value"), F.count("*")), 4).alias("avg_fan_sentiment")
    ).orderBy("release_year")


@query(
    "gq9_buzz_correlation",
    f"""WITH buzz AS (SELECT title_id, count(*) AS mentions, CAST(sum(value) AS DOUBLE) / count(*) AS buzz_score
      FROM fans WHERE event_type = 'CLICK' GROUP BY title_id),
    first_week AS (SELECT f.title_id, CAST(sum(total_gross_usd) AS DOUBLE) AS week1_revenue
      FROM fact f JOIN dim_titles t ON f.title_id = t.title_id
      WHERE report_date <= release_date + 7 GROUP BY f.title_id)
    SELECT genre, {r('corr(buzz_score, week1_revenue)', 4)} AS correlation_coefficient,
      {r('avg(CASE WHEN buzz_score > 30 THEN week1_revenue END)', 1)} AS high_buzz_avg_rev
    FROM buzz JOIN first_week USING (title_id) JOIN dim_titles USING (title_id) GROUP BY genre""",
)
def gq9(t):
    buzz = domain.fan_activity(t).where(F.col("event_type") == "CLICK").groupBy("title_id").agg(
        ratio(F.sum("value"), F.count("*")).alias("buzz_score")
    )
    first = fact_with_titles(t, "release_date").where(F.col("report_date") <= F.date_add("release_date", 7))
    first = first.groupBy("title_id").agg(F.sum("total_gross_usd").cast("double").alias("week1_revenue"))
    genres = layers.dim_titles(t).select("title_id", "genre")
    return buzz.join(first, "title_id").join(genres, "title_id").groupBy("genre").agg(
        rounded(F.corr("buzz_score", "week1_revenue"), 4).alias("correlation_coefficient"),
        rounded(F.avg(F.when(F.col("buzz_score") > 30, F.col("week1_revenue"))), 1).alias("high_buzz_avg_rev"),
    )


@query(
    "gq10_ltv_cohorts",
    f"""WITH tickets AS (SELECT o_custkey AS fan_id, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS spend FROM orders GROUP BY 1),
    subs AS (SELECT fan_id, sum(value) AS spend FROM fans WHERE event_type = 'STREAM' GROUP BY 1),
    merch AS (SELECT fan_id, sum(value) AS spend FROM fans WHERE event_type = 'PURCHASE' GROUP BY 1)
    SELECT CAST(date_trunc('year', signup_date) AS DATE) AS cohort_year, count(DISTINCT d.fan_id) AS cohort_size,
      {r('sum(coalesce(tickets.spend, 0) + coalesce(subs.spend, 0) + coalesce(merch.spend, 0))', 2)} AS total_cohort_revenue,
      {r('CAST(sum(coalesce(tickets.spend, 0) + coalesce(subs.spend, 0) + coalesce(merch.spend, 0)) AS DOUBLE) / count(DISTINCT d.fan_id)', 2)} AS avg_ltv
    FROM dim_fans d LEFT JOIN tickets ON tickets.fan_id = d.fan_id LEFT JOIN subs ON subs.fan_id = d.fan_id
      LEFT JOIN merch ON merch.fan_id = d.fan_id GROUP BY 1""",
)
def gq10(t):
    spent = domain.fan_activity(t).where(F.col("fan_id").isNotNull())

    def spend(kind):
        return spent.where(F.col("event_type") == kind).groupBy("fan_id").agg(F.sum("value").alias(f"{kind}_spend"))

    tickets = t.orders.groupBy(F.col("o_custkey").alias("fan_id")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("ticket_spend")
    )
    joined = layers.dim_fans(t).select("fan_id", "signup_date").join(tickets, "fan_id", "left")
    joined = joined.join(spend("STREAM"), "fan_id", "left").join(spend("PURCHASE"), "fan_id", "left")
    parts = [F.coalesce(F.col(c), F.lit(0)) for c in ("ticket_spend", "STREAM_spend", "PURCHASE_spend")]
    return joined.groupBy(calendar_date("signup_date", "year").alias("cohort_year")).agg(
        F.countDistinct("fan_id").alias("cohort_size"),
        rounded(F.sum(parts[0] + parts[1] + parts[2]), 2).alias("total_cohort_revenue"),
        rounded(ratio(F.sum(parts[0] + parts[1] + parts[2]), F.countDistinct("fan_id")), 2).alias("avg_ltv"),
    ).orderBy(F.desc("cohort_year"))


@query(
    "rq1_released_by_file",
    """SELECT franchise AS source_file, count(*) AS titles,
    count(*) FILTER (WHERE production_status = 'RELEASED') AS released FROM titles_raw GROUP BY franchise""",
)
def rq1(t):
    return domain.titles_raw(t).groupBy(F.col("franchise").alias("source_file")).agg(
        F.count("*").alias("titles"),
        F.count_if(F.col("production_status") == "RELEASED").alias("released"),
    )


@query(
    "rq2_one_title_across_files",
    f"""SELECT title_name AS title, production_status AS status, imdb_score, franchise AS source_file, version
    FROM titles_raw WHERE title_id = {TITLE_ID}""",
)
def rq2(t):
    return domain.titles_raw(t).where(F.col("title_id") == TITLE_ID).select(
        F.col("title_name").alias("title"), F.col("production_status").alias("status"), "imdb_score",
        F.col("franchise").alias("source_file"), "version",
    )


@query(
    "wq1_monthly_regional_sales",
    f"""SELECT region, CAST(date_trunc('month', report_date) AS DATE) AS month, {r('sum(gross_usd)', 2)} AS total_sales,
    count(DISTINCT theater_id) AS unique_theaters FROM box
    WHERE report_date >= CAST((SELECT max(report_date) FROM box) - INTERVAL 2 YEAR AS DATE) GROUP BY 1, 2""",
)
def wq1(t):
    last = t.lineitem.agg(F.max("l_shipdate").cast("date").alias("d"))
    recent = domain.box_office(t, last.select(F.add_months("d", -24)).first()[0])
    return recent.groupBy("region", calendar_date("report_date", "month").alias("month")).agg(
        rounded(F.sum("gross_usd"), 2).alias("total_sales"), F.countDistinct("theater_id").alias("unique_theaters")
    ).orderBy("region", "month")


@query(
    "wq2_profit_components",
    f"""WITH s AS (SELECT sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS revenue,
      sum(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2))) AS discounts,
      sum(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(4,2))) AS taxes FROM lineitem)
    SELECT 'Revenue' AS component, 1 AS sort_order, {r('revenue', 2)} AS amount FROM s
    UNION ALL SELECT 'Discounts', 2, {r('-discounts', 2)} FROM s
    UNION ALL SELECT 'Net Revenue', 3, {r('revenue - discounts', 2)} FROM s
    UNION ALL SELECT 'Taxes', 4, {r('-taxes', 2)} FROM s
    UNION ALL SELECT 'Net Income', 5, {r('revenue - discounts - taxes', 2)} FROM s""",
)
def wq2(t):
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    sums = t.lineitem.agg(
        F.sum(price).alias("revenue"),
        F.sum(price * F.col("l_discount").cast("decimal(4,2)")).alias("discounts"),
        F.sum(price * F.col("l_tax").cast("decimal(4,2)")).alias("taxes"),
    )
    parts = [
        ("Revenue", F.col("revenue")),
        ("Discounts", -F.col("discounts")),
        ("Net Revenue", F.col("revenue") - F.col("discounts")),
        ("Taxes", -F.col("taxes")),
        ("Net Income", F.col("revenue") - F.col("discounts") - F.col("taxes")),
    ]
    rows = F.array(*[
        F.struct(F.lit(name).alias("component"), F.lit(i).alias("sort_order"), rounded(c, 2).alias("amount"))
        for i, (name, c) in enumerate(parts, 1)
    ])
    return sums.select(F.inline(rows)).orderBy("sort_order")


@query(
    "wq3_recurring_revenue_by_month",
    f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {r('sum(CAST(o_totalprice AS DECIMAL(15,2)))', 2)} AS mrr
    FROM orders WHERE o_orderstatus = 'O' GROUP BY 1""",
)
def wq3(t):
    active = t.orders.where(F.col("o_orderstatus") == "O")
    return active.groupBy(calendar_date("o_orderdate", "month").alias("month")).agg(
        rounded(F.sum(F.col("o_totalprice").cast("decimal(15,2)")), 2).alias("mrr")
    )
