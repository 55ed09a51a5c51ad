"""One entry per operator: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from contract.relations import (
    AS_OF,
    CASED,
    EVENTS_AS_OF,
    SAMPLE,
    SINGLE_WORDS,
    TEST_SOURCES,
    event_postings,
    joined,
    payloads,
    pick,
    postings,
    stored_postings,
    raw_postings,
    stamp,
    table,
    with_faults,
)
from rolelake.functions import dates, text, urls
from rolelake.operators import dedup, matching, matching_join, quality, ranking
from rolelake.operators.durable import cut_lineage, ensure_checkpoint_dir, shared_folder
from rolelake.plans import cycle, index, logs, records, runs, sqlfunctions, store, summaries, views
from rolelake.sources import cards, links
from rolelake.sources import payloads as payload_source

QUERIES = {}


def register(build):
    QUERIES[build.__name__] = build
    return build


# -- sources --------------------------------------------------------------------------------


@register
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", spread=True)
    found = links.page_links(pages, ["/th", "/d", "/"], min_title_length=4)
    return found.select("page_id", "pos", "href", "job_title", "posting_url")


@register
def page_links_hard(spark, sf_dir):
    """The same links from pages whose attributes, comments and scripts hold what looks like markup."""
    before = """<div title="<!--" data-a='<script>' data-b="<a href='/x'>"><!-- <a href="/no">no</a> --><script src="a>b">"<a href='/no'>"</script>"""
    pages = table(spark, sf_dir, "pages", spread=True)
    hard = pages.withColumn("html", F.concat(F.lit(before), "html", F.lit("""<style media="<!--">a</style><p title='--><!--'></p></div>""")))
    found = links.page_links(hard, ["/th", "/d", "/"], min_title_length=4)
    return found.select("page_id", "pos", "href", "job_title", "posting_url")


@register
def page_cards(spark, sf_dir):
    rules = cards.LinkRules(
        source="Other",
        base_url="https://jobs.example.com",
        patterns=("/th", "/d", "/"),
        climb=6,
        min_title_length=1,
        skip_own_url=True,
        company_href="/a",
        find_city=True,
        cities=("und", "the", "de", "la"),
        default_place="nowhere",
        block_tags=("nav", "article"),
    )
    found = cards.page_cards(table(spark, sf_dir, "pages", spread=True), rules, AS_OF)
    return found.select("page_id", "pos", "job_title", "company", "location", "posting_url", "salary_text")


@register
def payload_fields(spark, sf_dir):
    return payload_source.payload_fields(payloads(spark, sf_dir), payload_source.BRIGHTERMONDAY).select(
        "event_id", F.col("item_pos").cast("bigint").alias("item_pos"), "raw_title", "raw_url",
        "raw_company", "raw_location", "raw_salary",
    )


@register
def page_containers(spark, sf_dir):
    rules = cards.ContainerRules(
        source="Other",
        base_url="https://jobs.example.com",
        card=("nav", None),
        title_paths=((("h2", None), ("a", None)), (("li", None), ("a", None))),
        logo_path=(("li", None), ("img", None)),
        description=("ul", None),
        date_tag="footer",
        date_id="date",
        place_href="/d",
        default_place="nowhere",
    )
    found = cards.page_cards(table(spark, sf_dir, "pages", spread=True), rules, AS_OF)
    return found.select(
        "page_id", "job_title", "company", "location", "posting_url", "description_snippet",
        stamp("posted_date").alias("posted_date"),
    )


@register
def payload_postings(spark, sf_dir):
    found = payload_source.payload_postings(
        payloads(spark, sf_dir), payload_source.BRIGHTERMONDAY, EVENTS_AS_OF
    )
    return found.select(
        "event_id", "job_title", "company", "location", "posting_url", "source", "salary_text",
        "description_snippet", stamp("posted_date").alias("posted_date"),
    )


@register
def union_fallback_overall(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    methods = [events.where(F.col("event_type") == kind) for kind in ("absent", "signup", "view")]
    return dedup.union_with_fallback(methods, None)


@register
def union_fallback(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    methods = [
        events.where("event_type = 'signup' and user_id % 3 = 0"),
        events.where("event_type = 'click' and user_id % 2 = 0"),
        events.where("event_type = 'view'"),
    ]
    return dedup.union_with_fallback(methods, "user_id")


# -- inserting, duplicates, logs ------------------------------------------------------------


def _existing(spark, sf_dir):
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")).distinct()
    return raw_postings(spark, sf_dir).join(labelled, "id", "left_semi")


@register
def merge_insert_new(spark, sf_dir):
    batch = raw_postings(spark, sf_dir)
    fresh = dedup.insert_if_absent(batch, _existing(spark, sf_dir), "posting_url", "seq")
    return fresh.select("posting_url", "seq", "source")


@register
def dedup_last(spark, sf_dir):
    rows = raw_postings(spark, sf_dir).select("posting_url", "seq", "company")
    return dedup.last_wins(rows, "posting_url", "seq")


@register
def dedup_first(spark, sf_dir):
    rows = raw_postings(spark, sf_dir).select("posting_url", "seq", "company")
    return dedup.first_wins(rows, "posting_url", "seq")


@register
def union_sources(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return dedup.union_sources(
        [
            events.where("event_type = 'view'").select("event_id", "user_id", "value"),
            events.where("event_type = 'click'").select("value", "event_id"),
            events.where("event_type = 'error'").select("event_id", "user_id"),
        ]
    )


@register
def run_log(spark, sf_dir):
    batch = raw_postings(spark, sf_dir)
    inserted = dedup.insert_if_absent(batch, _existing(spark, sf_dir), "posting_url", "seq")
    rows = logs.run_log_rows(batch, inserted, AS_OF, AS_OF + timedelta(seconds=90.5))
    return rows.select(
        "source", "jobs_found", "jobs_new", "jobs_failed", "status",
        stamp("scrape_start").alias("scrape_start"),
        F.col("duration_seconds").cast("double").alias("duration_seconds"),
    )


@register
def run_log_events(spark, sf_dir):
    status = F.when(F.col("event_type") == "signup", "partial").when(
        F.col("event_type") == "error", "failed"
    ).otherwise("success")
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), F.col("ts").alias("event_time"),
        status.alias("status"), F.col("event_id").alias("jobs_found"),
    )
    return logs.collapse_run_events(events).select(
        "run_id", stamp("scrape_start").alias("scrape_start"),
        stamp("scrape_end").alias("scrape_end"), "status", "jobs_found",
    )


@register
def notification_log(spark, sf_dir):
    batch = views.unnotified(stored_postings(spark, sf_dir), 2)
    log = logs.notification_log_rows(batch, "team@example.com", AS_OF, batch_id="b1")
    rows = logs.with_job_ids(log, logs.notification_id_rows(batch, AS_OF, "b1"))
    ids = F.array_join(F.transform("job_ids", lambda i: i.cast("string")), ",")
    return rows.select(
        "recipient", "subject", "jobs_count", "status", stamp("sent_at").alias("sent_at"),
        ids.alias("job_ids"),
    )


@register
def job_alerts(spark, sf_dir):
    batch = views.unnotified(event_postings(spark, sf_dir), 3)
    rows = logs.job_alert_rows(batch, "team@example.com", EVENTS_AS_OF)
    return rows.select("subject", F.col("jobs_count").cast("bigint").alias("jobs_count"), F.col("id").alias("job_id"))


@register
def notify_once(spark, sf_dir):
    """First cycle reports the older postings, the second finds only the rest."""
    jobs = stored_postings(spark, sf_dir)
    first = views.unnotified(jobs.where(F.col("scrape_timestamp") < AS_OF - timedelta(days=100)), 2)
    sent = first.select("id", F.lit(str(AS_OF)).cast("timestamp_ntz").alias("sent_at"))
    return views.unnotified(jobs, 2, notified=sent).select("id", "keyword_match_count", "posting_url")


@register
def mark_notified(spark, sf_dir):
    jobs = event_postings(spark, sf_dir).withColumns(
        {c: F.lit(None).cast("timestamp_ntz") for c in ("notification_sent_at", "updated_at")}
    )
    sent = views.unnotified(jobs, 3).select("id")
    return store.mark_notified(jobs, sent, EVENTS_AS_OF).select(
        "id", "is_notified", stamp("notification_sent_at").alias("notification_sent_at")
    )


@register
def seed_dimension(spark, sf_dir):
    events, documents = table(spark, sf_dir, "events"), table(spark, sf_dir, "documents")
    dimension = events.groupBy(F.col("event_type").alias("keyword")).agg(
        (F.count("*") % 5 + 1).alias("priority"), F.lit("event").alias("category")
    )
    seed = documents.select(
        F.col("lang").alias("keyword"), F.lit(1).cast("bigint").alias("priority"), F.lit("lang").alias("category")
    ).union(events.select("event_type", F.lit(5).cast("bigint"), F.lit("seed"))).distinct()
    return store.seeded(dimension, seed)


# -- checks and records ---------------------------------------------------------------------


@register
def validate_rows(spark, sf_dir):
    rows = quality.with_validation(with_faults(raw_postings(spark, sf_dir)), TEST_SOURCES)
    return rows.select("id", "valid", joined("errors").alias("errors"))


@register
def constraint_errors(spark, sf_dir):
    rows = with_faults(raw_postings(spark, sf_dir))
    rules = [
        *(c for c in quality.POSTING_CONSTRAINTS if c.column != "source"),
        quality.Constraint("source", not_null=True, max_length=50, one_of=TEST_SOURCES),
        quality.Constraint("seq", between=(10, 900)),
    ]
    return rows.select("id", joined(quality.constraint_errors(rules)).alias("errors"))


@register
def stored_record(spark, sf_dir):
    rows = records.stored_record(postings(spark, sf_dir), metadata_as_json=True)
    return rows.select(
        "seq", F.md5("job_title").alias("title_md5"), "company", "posting_url",
        joined("keywords_matched").alias("keywords_matched"),
        F.col("keyword_match_count").cast("bigint").alias("keyword_match_count"), "metadata",
        F.date_format("posted_date", "yyyy-MM-dd").alias("posted_date"),
    )


@register
def derived_columns(spark, sf_dir):
    rows = event_postings(spark, sf_dir).withColumn("updated_at", F.col("scrape_timestamp"))
    changed = F.col("id") % 4 == 1
    return records.touched(rows.drop("keyword_match_count"), EVENTS_AS_OF, changed).select(
        "id", F.col("keyword_match_count").cast("bigint").alias("keyword_match_count"),
        stamp("updated_at").alias("updated_at"),
    )


# -- selections -----------------------------------------------------------------------------


@register
def recent_matched(spark, sf_dir):
    return views.recent_matched(postings(spark, sf_dir), AS_OF).select(
        "id", "company", "posting_url", joined("keywords_matched").alias("keywords_matched"),
        F.col("keyword_match_count").cast("bigint").alias("keyword_match_count"),
        stamp("scrape_timestamp").alias("scrape_timestamp"), "is_notified",
    )


@register
def new_with_keywords(spark, sf_dir):
    return views.new_with_keywords(event_postings(spark, sf_dir), EVENTS_AS_OF, 36, 2).select(
        "id", "company", "source", F.col("keyword_match_count").cast("bigint").alias("keyword_match_count"),
        stamp("scrape_timestamp").alias("scrape_timestamp"),
    )


@register
def by_source(spark, sf_dir):
    return views.by_source(event_postings(spark, sf_dir), "click", EVENTS_AS_OF, 7).select(
        "id", "company", "source", "is_active", stamp("scrape_timestamp").alias("scrape_timestamp")
    )


@register
def unnotified(spark, sf_dir):
    return views.unnotified(stored_postings(spark, sf_dir), 3).select(
        "id", "company", joined("keywords_matched").alias("keywords_matched"), "posting_url"
    )


@register
def unnotified_brief(spark, sf_dir):
    return views.unnotified_brief(stored_postings(spark, sf_dir)).select(
        "job_id", "company", "location",
        F.col("keyword_match_count").cast("bigint").alias("keyword_match_count"), "posting_url",
    )


@register
def keyword_search(spark, sf_dir):
    return views.keyword_search(stored_postings(spark, sf_dir), ["Rewh", "License", "Absent"]).select(
        "job_id", "company", joined("keywords_matched").alias("keywords_matched"), "posting_url"
    )


@register
def keyword_search_lists(spark, sf_dir):
    """The search by posting lists, after a part of the postings got other keywords."""
    jobs = stored_postings(spark, sf_dir).withColumn("scrape_date", F.to_date("scrape_timestamp"))
    lists = index.KeywordIndex(spark, shared_folder(spark))
    lists.add(jobs)
    updates = jobs.where("id % 4 = 1").select("id", F.array(F.lit("Rewh"), F.lit("New")).alias("keywords_matched"))
    changed = cut_lineage(store.relabelled(jobs, updates))
    lists.add(changed.where("id % 4 = 1"))
    return lists.search(changed, ["Rewh", "License", "Absent"]).select(
        "job_id", "company", joined("keywords_matched").alias("keywords_matched"), "posting_url"
    )


@register
def merge_insert_keys(spark, sf_dir):
    """Rows with new URLs, found by the bucketed keys of the postings that are there."""
    keys = index.UrlKeys(spark, shared_folder(spark))
    keys.rebuild(_existing(spark, sf_dir))
    return keys.absent(raw_postings(spark, sf_dir)).select("posting_url", "seq", "source")


def _sql_relations(spark, sf_dir):
    """The relations that the functions of SQL read, as views."""
    stored_postings(spark, sf_dir).createOrReplaceTempView("sql_jobs")
    log = table(spark, sf_dir, "events").select(F.col("ts").alias("scrape_start"), F.col("ts").alias("sent_at"), "event_id")
    log.where("event_id % 2 = 0").createOrReplaceTempView("sql_runs")
    log.where("event_id % 2 = 1").createOrReplaceTempView("sql_notices")
    sqlfunctions.register(spark, "sql_jobs", "sql_runs", "sql_notices")


@register
def sql_jobs_by_keywords(spark, sf_dir):
    _sql_relations(spark, sf_dir)
    return spark.sql("""SELECT job_id, company, array_join(keywords_matched, '|') AS keywords_matched, posting_url
                        FROM get_jobs_by_keywords(array('Rewh', 'License', 'Absent'))""")


@register
def sql_unnotified(spark, sf_dir):
    _sql_relations(spark, sf_dir)
    return spark.sql("SELECT job_id, company, location, CAST(keyword_match_count AS BIGINT) AS keyword_match_count, posting_url FROM get_unnotified_jobs()")


@register
def sql_archive_and_logs(spark, sf_dir):
    """How many rows the two procedures of SQL would change, by day."""
    _sql_relations(spark, sf_dir)
    return spark.sql("""
        SELECT 'job' AS kind, date_format(scrape_timestamp, 'yyyy-MM-dd') AS day, count(*) AS n
        FROM get_jobs_to_archive(TIMESTAMP_NTZ '2024-02-01 00:00:00', 90) GROUP BY ALL
        UNION ALL
        SELECT log, date_format(logged_at, 'yyyy-MM-dd'), count(*) FROM get_old_logs(TIMESTAMP_NTZ '2024-01-30 12:00:00', 15) GROUP BY ALL""")


@register
def sql_jobs_by_source(spark, sf_dir):
    _sql_relations(spark, sf_dir)
    return spark.sql("SELECT job_id, company, posting_url FROM get_jobs_by_source('src3', TIMESTAMP_NTZ '2024-02-01 00:00:00', 60)")


# -- keyword matching -----------------------------------------------------------------------


@register
def keyword_match(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True)
    labelled = docs.select("doc_id", matching.match_keywords("text", SAMPLE).alias("keywords_matched"))
    return matching.each_keyword(labelled, "doc_id")


@register
def keyword_match_cased(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True)
    labelled = docs.select("doc_id", matching.match_keywords("text", CASED).alias("keywords_matched"))
    return matching.each_keyword(labelled, "doc_id")


@register
def keyword_match_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True)
    labelled = matching_join.keywords_by_join(docs, "doc_id", "text", SAMPLE.variant_table(spark))
    return matching.each_keyword(labelled, "doc_id")


@register
def keyword_score(spark, sf_dir):
    return postings(spark, sf_dir).select("id", "keyword_score")


@register
def keyword_score_join(spark, sf_dir):
    rows = raw_postings(spark, sf_dir, spread=True).select(
        "id", "job_title", matching.combined_text("job_title", "full_description").alias("t")
    )
    variants = SAMPLE.variant_table(spark)
    in_text = matching_join.keyword_pairs(rows, "id", "t", variants).where("keyword is not null").distinct()
    in_title = (
        matching_join.keyword_pairs(rows, "id", "job_title", variants)
        .where("keyword is not null")
        .distinct()
        .withColumn("in_title", F.lit(True))
    )
    pairs = in_text.join(in_title, ["id", "keyword"], "left").withColumn(
        "in_title", F.coalesce("in_title", F.lit(False))
    )
    return matching_join.score_pairs(pairs, SAMPLE.weight_table(spark), "id")


@register
def label_postings(spark, sf_dir):
    return postings(spark, sf_dir).select(
        "id", joined("keywords_matched").alias("keywords_matched"),
        F.col("keyword_count").cast("bigint").alias("keyword_count"), "keyword_score",
    )


@register
def relabel(spark, sf_dir):
    jobs = event_postings(spark, sf_dir).select("id", "keywords_matched", "keyword_match_count")
    updates = postings(spark, sf_dir).select("id", "keywords_matched")
    return store.relabelled(jobs, updates).select(
        "id", joined("keywords_matched").alias("keywords_matched"),
        F.col("keyword_match_count").cast("bigint").alias("keyword_match_count"),
    )


@register
def keyword_frequency(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True).select(
        "doc_id", "text", matching.match_keywords("text", SAMPLE).alias("keywords_matched")
    )
    return matching.keyword_frequency(docs, SAMPLE, "text").select(
        "doc_id", "keyword", F.col("occurrences").cast("bigint").alias("occurrences")
    )


@register
def keyword_context(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True).select(
        "doc_id", "text", matching.match_keywords("text", SINGLE_WORDS).alias("keywords_matched")
    )
    return matching.keyword_context(docs, SINGLE_WORDS, "text").select(
        "doc_id", "keyword", F.col("occurrence").cast("bigint").alias("occurrence"), "context"
    )


@register
def skill_categories(spark, sf_dir):
    jobs = postings(spark, sf_dir).select("id", "keywords_matched")
    categories = matching.skill_categories("keywords_matched", SAMPLE)
    return jobs.select("id", F.explode(categories).alias("category", "k")).select(
        "id", "category", joined("k").alias("keywords")
    )


@register
def skill_categories_join(spark, sf_dir):
    pairs = matching.each_keyword(postings(spark, sf_dir), "id")
    found = matching_join.categorize_pairs(pairs, SAMPLE.category_table(spark), "id")
    return found.select("id", "category", joined("keywords").alias("keywords"))


@register
def skill_suggestions(spark, sf_dir):
    jobs = postings(spark, sf_dir).select("id", "keywords_matched")
    return jobs.select("id", joined(matching.suggest_missing_skills("keywords_matched", SAMPLE)).alias("suggested"))


@register
def skill_suggestions_join(spark, sf_dir):
    pairs = matching.each_keyword(stored_postings(spark, sf_dir), "id")
    return matching_join.suggest_for_pairs(pairs, SAMPLE.pairing_table(spark), "id")


# -- aggregates, ranks ----------------------------------------------------------------------


@register
def daily_stats(spark, sf_dir):
    return views.daily_stats(event_postings(spark, sf_dir), EVENTS_AS_OF, 30).withColumn(
        "scrape_date", F.date_format("scrape_date", "yyyy-MM-dd")
    )


@register
def trending_keywords(spark, sf_dir):
    return views.trending_keywords(postings(spark, sf_dir), AS_OF).withColumn(
        "last_seen", stamp("last_seen")
    )


@register
def trending_keywords_by_name(spark, sf_dir):
    views.register_views(postings(spark, sf_dir), AS_OF)
    return spark.sql("SELECT * FROM trending_keywords").withColumn(
        "last_seen", stamp("last_seen")
    )


@register
def company_stats(spark, sf_dir):
    return views.company_stats(postings(spark, sf_dir), AS_OF).withColumns(
        {"first_seen": stamp("first_seen"), "last_seen": stamp("last_seen"), "job_boards": joined("job_boards")}
    )


@register
def global_stats(spark, sf_dir):
    return views.global_stats(event_postings(spark, sf_dir), EVENTS_AS_OF).withColumn(
        "last_scrape", stamp("last_scrape")
    )


def _summarised(spark, jobs):
    """Postings with their day, and the daily summaries made from them."""
    dated = jobs.withColumn("scrape_date", F.to_date("scrape_timestamp"))
    made = summaries.DailySummaries(spark, shared_folder(spark))
    made.replace(dated)
    return made, dated


@register
def summarised_daily_stats(spark, sf_dir):
    made, jobs = _summarised(spark, event_postings(spark, sf_dir))
    return made.daily_stats(jobs, EVENTS_AS_OF, 30).withColumn("scrape_date", F.date_format("scrape_date", "yyyy-MM-dd"))


@register
def summarised_trending_keywords(spark, sf_dir):
    made, jobs = _summarised(spark, stored_postings(spark, sf_dir))
    return made.trending_keywords(jobs, AS_OF).withColumn("last_seen", stamp("last_seen"))


@register
def summarised_company_stats(spark, sf_dir):
    made, jobs = _summarised(spark, stored_postings(spark, sf_dir))
    return made.company_stats(jobs, AS_OF).withColumns(
        {"first_seen": stamp("first_seen"), "last_seen": stamp("last_seen"), "job_boards": joined("job_boards")}
    )


@register
def summarised_global_stats(spark, sf_dir):
    made, jobs = _summarised(spark, event_postings(spark, sf_dir))
    return made.global_stats(jobs, EVENTS_AS_OF).withColumn("last_scrape", stamp("last_scrape"))


@register
def batch_analysis(spark, sf_dir):
    listed = F.transform("top_keywords", lambda e: F.concat(e["keyword"], F.lit(":"), e["n"].cast("string")))
    return views.batch_analysis(stored_postings(spark, sf_dir)).withColumn("top_keywords", joined(listed))


@register
def digest_summary(spark, sf_dir):
    return views.digest_summary(views.unnotified(stored_postings(spark, sf_dir)))


@register
def match_rate(spark, sf_dir):
    return views.match_rate(postings(spark, sf_dir))


@register
def top_matches(spark, sf_dir):
    found = ranking.top_matches(postings(spark, sf_dir), k=5)
    return found.select("seq", "source", joined("keywords_shown").alias("keywords_shown"))


@register
def newest_unlabelled(spark, sf_dir):
    """Whole stored rows, with a digest of the texts that are handed out."""
    jobs = cut_lineage(postings(spark, sf_dir))
    return ranking.newest_unlabelled(jobs, 100).select(
        "id", stamp("scrape_timestamp").alias("scrape_timestamp"), F.md5("job_title").alias("title_md5"), F.md5("full_description").alias("text_md5")
    )


@register
def top_keywords(spark, sf_dir):
    return ranking.top_keywords(postings(spark, sf_dir), 10)


@register
def digest_rank(spark, sf_dir):
    return views.digest_rank(views.unnotified(event_postings(spark, sf_dir))).select("id", "position")


# -- column functions -----------------------------------------------------------------------


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents", spread=True)


@register
def clean_text(spark, sf_dir):
    cleaned = _documents(spark, sf_dir).select("doc_id", text.clean_text("text").alias("c"))
    return cleaned.select("doc_id", F.length("c").cast("bigint").alias("n"), F.md5("c").alias("cleaned_md5"))


@register
def truncate_text(spark, sf_dir):
    cut = _documents(spark, sf_dir).select("doc_id", text.truncate_text("text", 500).alias("c"))
    return cut.select("doc_id", F.length("c").cast("bigint").alias("n"), F.md5("c").alias("cut_md5"))


@register
def extract_salary(spark, sf_dir):
    n = F.col("doc_id").cast("string")
    forms = [
        F.concat(F.lit("pay KES "), n, F.lit(",000 - kes "), n, F.lit(",500 per month")),
        F.concat(n, F.lit(",000 - 9,999,999 KES")),
        F.concat(F.lit("Ksh. "), n, F.lit("  -  KSH "), n),
        F.concat(n, F.lit("-"), n, F.lit(" per  month")),
        F.concat(F.lit("Ksh "), n, F.lit(" to Ksh 75,000 or KES 1")),
        F.lit("competitive"),
    ]
    offered = _documents(spark, sf_dir).select(
        "doc_id", F.concat_ws(" ", "text", pick("doc_id", forms), "text").alias("t")
    )
    return offered.select("doc_id", text.extract_salary("t").alias("salary"))


@register
def normalize_location(spark, sf_dir):
    places = [
        None, "", "Westlands, Nairobi County", "NAIROBI,  KENYA", "remote - kenya role",
        "Anywhere in Kenya", "Nairobi CBD & more", F.concat(F.lit("Thika @ "), F.col("lang")), "@@",
        F.col("text"),
    ]
    placed = _documents(spark, sf_dir).select("doc_id", pick("doc_id", places).alias("place"))
    return placed.select("doc_id", F.md5(text.normalize_location("place")).alias("location_md5"))


def _date_texts(spark, sf_dir):
    n, ts = F.col("event_id"), F.col("ts")
    words = [
        "Today", " just now ", "Posted Yesterday",
        F.concat((n % 50).cast("string"), F.lit(" days ago")),
        F.concat((n % 9).cast("string"), F.lit(" week ago")),
        F.concat((n % 5).cast("string"), F.lit("months")),
        F.concat((n % 70).cast("string"), F.lit(" HOURS ago")),
        "30+ days ago", "10 minutes ago", None, "",
        F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "d/M/yyyy"), F.date_format(ts, "dd-MM-yyyy"),
        F.date_format(ts, "MMMM d, yyyy"), F.date_format(ts, "d MMMM yyyy"),
        F.upper(F.date_format(ts, "MMM d, yyyy")), F.date_format(ts, "dd  MMM yyyy"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), "31/02/2024",
    ]
    return table(spark, sf_dir, "events", spread=True).select("event_id", pick("event_id", words).alias("t"))


@register
def relative_date(spark, sf_dir):
    return _date_texts(spark, sf_dir).select(
        "event_id", stamp(dates.parse_relative_date("t", EVENTS_AS_OF)).alias("parsed")
    )


@register
def absolute_date(spark, sf_dir):
    return _date_texts(spark, sf_dir).select(
        "event_id", stamp(dates.parse_absolute_date("t")).alias("parsed")
    )


@register
def parse_date(spark, sf_dir):
    return _date_texts(spark, sf_dir).select(
        "event_id",
        stamp(dates.parse_date("t", EVENTS_AS_OF)).alias("parsed"),
        stamp(dates.parse_date("t", EVENTS_AS_OF, default=AS_OF)).alias("parsed_or_now"),
    )


def _links(spark, sf_dir):
    broken = [
        F.col("url"), F.concat(F.lit("  "), "url"), F.substring_index("url", "://", -1),
        F.concat(F.lit("1"), "url"), F.concat("url", F.lit("/a b")), None,
    ]
    return table(spark, sf_dir, "pages", spread=True).select("page_id", "url", pick("page_id", broken).alias("link"))


@register
def valid_url(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", urls.is_valid_url("link").alias("valid"))


@register
def url_domain(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", urls.extract_domain("link").alias("domain"))


@register
def absolute_url(spark, sf_dir):
    n = F.col("page_id").cast("string")
    relatives = [
        F.concat(F.lit("/abs/"), n), F.concat(F.lit("rel/"), n, F.lit("?a=1")),
        F.concat(F.lit("../../up/./"), n), F.concat(F.lit("//other.org/"), n),
        F.concat(F.lit("?q="), n), F.concat(F.lit("#f"), n), "", F.concat(F.lit("https://x.org/"), n),
    ]
    rows = table(spark, sf_dir, "pages", spread=True).select("page_id", "url", pick("page_id", relatives).alias("r"))
    return rows.select("page_id", urls.make_absolute_url("url", "r").alias("absolute"))


@register
def split_title(spark, sf_dir):
    n = F.col("doc_id").cast("string")
    endings = [
        F.concat(F.lit(" at Company "), n), "", F.concat(F.lit(" at Large at "), n), " attached",
    ]
    titles = _documents(spark, sf_dir).select(
        "doc_id",
        F.concat(F.substring_index("text", "\n", 1), pick("doc_id", endings)).alias("t"),
        pick("doc_id", [None, "Acme logo", "", None, "Beta Logo "]).alias("alt"),
    )
    title, from_title = text.split_title("t")
    return titles.select(
        "doc_id", F.md5(title).alias("title_md5"), text.organisation("alt", from_title).alias("company")
    )


@register
def first_city(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id", text.first_city("text", ["Rewh", "Thatin", "MIT", "von", "Que"], "none").alias("city")
    )


@register
def alias_chain(spark, sf_dir):
    """First filled field, else a default."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", pick("event_id", ["", None, F.col("event_type")]).alias("a"),
        pick("user_id", [None, F.col("props"), ""]).alias("b"),
    )
    return rows.select("event_id", text.first_filled("a", "b", default="N/A").alias("chosen"))


# -- state and retention ----------------------------------------------------------------------


@register
def archive_old(spark, sf_dir):
    jobs = raw_postings(spark, sf_dir).select("id", "is_active", "scrape_timestamp")
    return store.archived(jobs, AS_OF, 90).select("id", "is_active")


@register
def retain_logs(spark, sf_dir):
    log = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return logs.keep_recent(log, "ts", EVENTS_AS_OF, 15).select("event_id", "event_type")


@register
def incremental_cycle(spark, sf_dir):
    """Collect, validate, deduplicate, label and pick the rows to insert."""
    rows = with_faults(raw_postings(spark, sf_dir))
    sources = [rows.where("id % 2 = 1"), rows.where("id % 2 = 0").drop("salary_text")]
    labelled = cycle.labelled_batch(
        sources, SAMPLE, allowed_sources=TEST_SOURCES, text_columns=["job_title", "full_description"]
    )
    stored = records.stored_record(labelled)
    fits = F.size(quality.constraint_errors([c for c in quality.POSTING_CONSTRAINTS if c.column != "source"])) == 0
    fresh = store.new_postings(stored.where(fits), _existing(spark, sf_dir), AS_OF)
    return fresh.select(
        "posting_url", "source", F.md5("job_title").alias("title_md5"),
        joined("keywords_matched").alias("keywords_matched"),
        F.col("keyword_match_count").cast("bigint").alias("keyword_match_count"), "is_active",
        stamp("created_at").alias("created_at"),
    )


@register
def stored_cycle(spark, sf_dir):
    """Two runs into stored tables, each reporting once, then archiving and retention."""
    ensure_checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/tables-{uuid.uuid4().hex}"
    tables = store.PostingStore(spark, root)
    jobs = postings(spark, sf_dir).withColumn("source", F.lit("Other"))
    for rows, when in (
        (jobs.where("id % 2 = 0"), AS_OF - timedelta(days=200)),
        (jobs, AS_OF),
    ):
        done = tables.insert(records.stored_record(rows), when)
        tables.append(store.RUNS, logs.run_log_rows(done.batch, done.rows, when, when))
        cycle.notify_once(tables, lambda batch: True, "team@example.com", when, min_keywords=2)
    cycle.keep_house(tables, AS_OF)
    return tables.postings().select(
        "posting_url", "is_active", "is_notified",
        F.col("keyword_match_count").cast("bigint").alias("keyword_match_count"),
        stamp("created_at").alias("created_at"),
        stamp("notification_sent_at").alias("notification_sent_at"),
    )


def _faulty_run(spark, sf_dir):
    """A run over four sources: two with faulty rows, one without any, and one that breaks."""
    ensure_checkpoint_dir(spark)
    tables = store.PostingStore(spark, shared_folder(spark))
    rows = with_faults(raw_postings(spark, sf_dir)).withColumn("source", F.when(F.col("source").isNotNull(), "Other"))
    sources = {
        "odd": lambda: rows.where("id % 2 = 1"),
        "even": lambda: rows.where("id % 2 = 0"),
        "empty": lambda: rows.where("id < 0"),
        "broken": lambda: rows.withColumn("company", F.raise_error(F.lit("no answer"))),
    }
    log = runs.run_sources(tables, "run 1", sources, SAMPLE, AS_OF, lambda: AS_OF, text_columns=["job_title", "full_description"])
    return tables, log


@register
def cycle_run_log(spark, sf_dir):
    _, log = _faulty_run(spark, sf_dir)
    return log.select("source", "status", "jobs_found", "jobs_new", "jobs_failed", F.col("error_message").isNotNull().alias("has_error"))


@register
def cycle_rejected(spark, sf_dir):
    """Rows that validation rejected, read back from the whole rows that are kept of them."""
    tables, _ = _faulty_run(spark, sf_dir)
    rejected = tables.read(store.REJECTED_ROWS).where("stage = 'validation'")
    of_record = lambda c: F.get_json_object("record", f"$.{c}")
    return rejected.select(
        of_record("id").cast("bigint").alias("id"), joined("errors").alias("errors"), F.md5(of_record("full_description")).alias("text_md5")
    )
