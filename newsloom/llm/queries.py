"""Queries and SQL of the training-data operators, registered by ``__spark_entry__`` when this subpackage is present."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import endcounts, lines, pages, split, tokens, truncation, vectors
from .common import limits, shared, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return pages.boilerplate_lines(table(spark, d, "feeds"))


def p1_article(spark: SparkSession, d: str) -> DataFrame:
    return pages.once_per_id(pages.main_body(table(spark, d, "feeds")).where("body is not null").select("id", "body"), "id", "body")


def _languages(spark: SparkSession, d: str) -> DataFrame:
    feeds = table(spark, d, "feeds")
    names = pages.language_names(table(spark, d, "language_names"))
    return pages.page_languages(feeds, pages.fit_languages(feeds, names), names)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return pages.language_findings(_languages(spark, d))


def p2_languages(spark: SparkSession, d: str) -> DataFrame:
    return _languages(spark, d).select("id", "language", F.round("confidence", 4).alias("confidence"), "label_ok", F.size("segments").alias("n_segments"))


def _cut(spark: SparkSession, d: str, texts: bool) -> DataFrame:
    lim = limits(spark, d)
    return split.split_texts(table(spark, d, "feeds"), lim["piece_max_chars"], lim["piece_overlap_chars"], texts=texts)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return split.oversized(_cut(spark, d, False))


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _cut(spark, d, True).select("id", F.explode("pieces").alias("p")).select("id", "p.piece_no", "p.start_pos", "p.end_pos", "p.cut", "p.text")


def _clusters(spark: SparkSession, d: str) -> DataFrame:
    return vectors.clusters(table(spark, d, "feeds"), table(spark, d, "flashpoints"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return vectors.cluster_pairs(shared(_clusters(spark, d)))


def p4_clusters(spark: SparkSession, d: str) -> DataFrame:
    return vectors.cluster_records(shared(_clusters(spark, d)), table(spark, d, "feeds")).withColumnRenamed("topic", "flashpoint_id")


def p4_sizes(spark: SparkSession, d: str) -> DataFrame:
    found = _clusters(spark, d)
    return found.groupBy(F.col("topic").alias("flashpoint_id"), "cluster").agg(F.count("*").alias("article_count"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pages.residue(table(spark, d, "feeds")).select("id")


def p5_kept(spark: SparkSession, d: str) -> DataFrame:
    feeds = table(spark, d, "feeds")
    return feeds.select("id").distinct().join(pages.residue(feeds).select("id"), "id", "left_anti")


def _neighbours(spark: SparkSession, d: str) -> DataFrame:
    return vectors.nearest(table(spark, d, "feeds"), limits(spark, d)["neighbours_k"])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return vectors.neighbour_pairs(_neighbours(spark, d))


def p6_neighbours(spark: SparkSession, d: str) -> DataFrame:
    n = _neighbours(spark, d).select("id", F.posexplode("neighbours").alias("pos", "n"))
    return n.select("id", (F.col("pos") + 1).alias("rank"), F.col("n.id").alias("neighbour"), F.round("n.similarity", 4).alias("similarity"))


def p6_recall(spark: SparkSession, d: str) -> DataFrame:
    return vectors.recall(shared(_neighbours(spark, d)), table(spark, d, "feeds"), limits(spark, d)["neighbours_k"])


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    keyed = lines.pages(table(spark, d, "feeds"))
    return lines.marked(keyed, lines.standing(lines.counted(keyed))).select("id", "line_no")


def p7_clean(spark: SparkSession, d: str) -> DataFrame:
    keyed = lines.pages(table(spark, d, "feeds"))
    return lines.cleaned(table(spark, d, "feeds"), lines.marked(keyed, lines.repeated(lines.counted(keyed))))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"))


def _containers(spark: SparkSession, d: str) -> DataFrame:
    return tokens.packed_documents(table(spark, d, "documents"), limits(spark, d)["container_capacity_tokens"])


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _containers(spark, d).where("n_pieces > 1").select("doc_id").distinct()


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    return _containers(spark, d)


def _truncated(spark: SparkSession, d: str) -> DataFrame:
    return endcounts.truncated(table(spark, d, "documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _truncated(spark, d).where("truncated").select("doc_id")


def p10_sources(spark: SparkSession, d: str) -> DataFrame:
    return truncation.share_by_source(_truncated(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            p1_found, p1_article, p2_found, p2_languages, p3_found, p3_pieces, p4_found, p4_clusters, p4_sizes, p5_found, p5_kept,
            p6_found, p6_neighbours, p6_recall, p7_found, p7_clean, p8_ids, p9_found, p9_containers, p10_found, p10_sources,
        )
    }


_USABLE = """usable as (
    select id, min(flashpoint_id) as flashpoint_id, any_value(cast(embedding as double[])) as e from feeds
    where len(embedding) = 768 and list_inner_product(cast(embedding as double[]), cast(embedding as double[])) > 0 group by id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": """
            with f as (select distinct id, raw_text from feeds where length(raw_text) > 4000),
            l as (select id, unnest(string_split(raw_text, chr(10))) as line, generate_subscripts(string_split(raw_text, chr(10)), 1) as line_no from f)
            select id, 0 as line_no from f
            union all select id, cast(line_no as integer) from l where length(regexp_replace(line, '\\r$', '')) > 4000""",
        "p4_found": f"""
            with {_USABLE}, t as (select distinct id from flashpoints)
            select a.id as id_a, b.id as id_b from usable a join usable b on a.flashpoint_id = b.flashpoint_id and a.id < b.id
            where a.flashpoint_id in (select id from t) and list_cosine_similarity(a.e, b.e) >= 0.67""",
        "p4_sizes": f"""
            with {_USABLE}, t as (select distinct id from flashpoints),
            n as (select a.flashpoint_id, a.id, min(b.id) as other from usable a join usable b on a.flashpoint_id = b.flashpoint_id and a.id <> b.id
                where a.flashpoint_id in (select id from t) and list_cosine_similarity(a.e, b.e) >= 0.67 group by 1, 2)
            select flashpoint_id, least(id, other) as cluster, count(*) as article_count from n group by 1, 2""",
        "p6_found": f"""
            with {_USABLE}, s as (
                select a.id as a, b.id as b, row_number() over (partition by a.id order by round(list_cosine_similarity(a.e, b.e), 6) desc, b.id) as r
                from usable a join usable b on a.id <> b.id)
            select distinct least(a, b) as id_a, greatest(a, b) as id_b from s where r <= 5""",
        "p7_found": """
            with f as (
                select id, nullif(regexp_replace(lower(regexp_replace(any_value(domain), '^\\s+|\\s+$', '', 'g')), '^www\\.', ''), '') as domain, any_value(raw_text) as t
                from feeds where regexp_matches(raw_text, '\\S') group by id),
            g as (select * from f where domain is not null),
            l as (
                select id, domain, unnest(string_split(t, chr(10))) as raw, generate_subscripts(string_split(t, chr(10)), 1) as line_no from g),
            k as (
                select id, domain, line_no, regexp_replace(regexp_replace(regexp_replace(lower(raw), '[0-9]+', '0', 'g'), ' +', ' ', 'g'), '^\\s+|\\s+$', '', 'g') as key from l),
            n as (select domain, key, count(distinct id) as n from k where regexp_matches(key, '\\p{L}') group by domain, key),
            t as (select domain, count(*) as total from g group by domain)
            select k.id, cast(k.line_no as integer) as line_no from k join n using (domain, key) join t using (domain)
            where n.n >= 4 and n.n >= 0.05 * t.total""",
        "p7_clean": """
            with f as (
                select id, nullif(regexp_replace(lower(regexp_replace(any_value(domain), '^\\s+|\\s+$', '', 'g')), '^www\\.', ''), '') as domain, any_value(raw_text) as t, min(created_at)::date as day
                from feeds group by id),
            c as (select domain, t, min(day) as day, row_number() over () as page from f where domain is not null and regexp_matches(t, '\\S') group by domain, t),
            k as (select distinct domain, page, day, regexp_replace(regexp_replace(regexp_replace(lower(raw), '[0-9]+', '0', 'g'), ' +', ' ', 'g'), '^\\s+|\\s+$', '', 'g') as key
                from (select domain, page, day, unnest(string_split(t, chr(10))) as raw from c)),
            n as (select domain, key, count(*) as clusters, count(distinct day) as days from k where regexp_matches(key, '\\p{L}') group by domain, key),
            d as (select domain, count(*) as clusters, count(distinct day) as days from c group by domain),
            r as (select n.domain, n.key from n join d using (domain) where n.clusters >= 4 and n.clusters >= 0.05 * d.clusters and n.days >= least(2, d.days)),
            l as (select id, domain, unnest(string_split(t, chr(10))) as raw, generate_subscripts(string_split(t, chr(10)), 1) as no from f where domain is not null and regexp_matches(t, '\\S')),
            m as (select l.id, l.raw, l.no, r.key is not null as gone from l left join r on l.domain = r.domain and r.key = regexp_replace(regexp_replace(regexp_replace(lower(l.raw), '[0-9]+', '0', 'g'), ' +', ' ', 'g'), '^\\s+|\\s+$', '', 'g')),
            s as (select id, coalesce(string_agg(raw, chr(10) order by no) filter (where not gone), '') as text, count(*) filter (where gone)::integer as n_removed from m group by id)
            select f.id, case when coalesce(s.n_removed, 0) = 0 then f.t else s.text end as text, coalesce(s.n_removed, 0) as n_removed from f left join s using (id)""",
    }
