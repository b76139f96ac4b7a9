"""Queries of the reference's own operators with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import language as L
from ..functions import page as H
from ..functions import text as X
from ..operators import aggregate as A
from ..operators import cluster as C
from ..operators import compress as Z
from ..operators import meta as N
from ..operators import metrics as M
from ..operators import packing as K
from ..operators import topics as TP
from ..session import scratch
from ..sources import store as S
from ..streaming import windows as W

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _feeds(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Feeds once for each id, narrowed to the columns a query needs before anything is shuffled."""
    return _t(spark, d, "feeds").select("id", *columns).dropDuplicates(["id"])


def _once(*columns: str) -> str:
    return f"(select distinct id, {', '.join(columns)} from feeds)" if columns else "(select distinct id from feeds)"


# sources


@_query(f"select 'feed_entries_' || strftime(created_at, '%Y%m%d') as table_name, count(*) as n from {_once('created_at')} group by 1")
def src1_daily_partition(spark, d):
    return _feeds(spark, d, "created_at").groupBy(TP.daily_name("feed_entries", F.col("created_at")).alias("table_name")).agg(F.count("*").alias("n"))


@_query("select id, title from flashpoints where id in (select lower(trim(flashpoint_id)) from feeds)")
def src3_id_list(spark, d):
    return S.by_ids(_t(spark, d, "flashpoints"), _t(spark, d, "feeds").select(F.col("flashpoint_id").alias("id")).distinct()).select("id", "title")


@_query(f"""select p.id, count(f.id) as n_feeds, coalesce(string_agg(f.id, ',' order by f.created_at, f.id), '') as feed_ids
    from flashpoints p left join {_once('flashpoint_id', 'created_at')} f on f.flashpoint_id = p.id group by p.id""")
def src5_nested_topics(spark, d):
    n = TP.nested(_t(spark, d, "flashpoints").select("id"), _feeds(spark, d, "flashpoint_id", "created_at"))
    return n.select("id", F.size("feeds").cast("long").alias("n_feeds"), F.array_join(F.transform("feeds", lambda x: x["id"]), ",").alias("feed_ids"))


@_query("select id, len(domains) as n, array_to_string(domains, '|') as domains from flashpoints")
def src7_json_list(spark, d):
    p = _t(spark, d, "flashpoints").select("id", X.json_list(F.to_json("domains")).alias("domains"))
    return p.select("id", F.size("domains").cast("long").alias("n"), F.array_join("domains", "|").alias("domains"))


_TIME = """coalesce(try_strptime(trim(seendate), '%Y-%m-%dT%H:%M:%S'), try_strptime(trim(seendate), '%Y-%m-%d %H:%M:%S'), try_strptime(trim(seendate), '%Y%m%dT%H%M%SZ'),
    try_strptime(trim(seendate), '%Y-%m-%dT%H:%M:%SZ'), try_strptime(trim(seendate), '%Y-%m-%d'), try_strptime(trim(seendate), '%d/%m/%Y'))"""


@_query(f"""select url, title, strftime(seen, '%Y-%m-%d %H:%M:%S') as seen_at, image, domain, language, sourcecountry from (select *, row_number() over (partition by url
        order by seen desc nulls last, title desc nulls last, image desc nulls last, domain desc nulls last, language desc nulls last, sourcecountry desc nulls last) as r
    from (select url, title, {_TIME} as seen, socialimage as image, domain, language, coalesce(nullif(sourcecountry, ''), 'unknown') as sourcecountry from api_articles where url is not null and title is not null)) where r = 1""")
def src17_api_articles(spark, d):
    return S.api_articles(_t(spark, d, "api_articles")).withColumn("seen_at", F.date_format("seen_at", "yyyy-MM-dd HH:mm:ss"))


@_query(f"""select flashpoint_id, id, coalesce(nullif(image, ''), 'unknown') as image, coalesce(nullif(language, ''), 'unknown') as language, raw_text as document
    from {_once('flashpoint_id', 'image', 'language', 'raw_text', 'embedding')} where len(embedding) > 0 and trim(raw_text) <> ''""")
def src18_collection_rows(spark, d):
    f = _feeds(spark, d, "flashpoint_id", "url", "image", "domain", "sourcecountry", "language", "raw_text", "summary", "embedding")
    return S.collection_rows(f).select("flashpoint_id", "id", "metadata.image", "metadata.language", "document")


@_query("""with q as (select embedding as e from embeddings where vec_id = (select min(vec_id) from embeddings))
    select vec_id, round(list_cosine_similarity(cast(embedding as double[]), cast(q.e as double[])), 5) as similarity from embeddings, q
    order by list_cosine_similarity(cast(embedding as double[]), cast(q.e as double[])) desc, vec_id limit 5""")
def src20_knn(spark, d):
    e = _t(spark, d, "embeddings")
    first = e.orderBy("vec_id").select("embedding").first()
    if first is None:
        return e.select("vec_id", F.lit(0.0).alias("similarity")).limit(0)
    return S.query_similar(e, first.embedding, 5, "vec_id").select("vec_id", F.round("similarity", 5).alias("similarity"))


@_query("""select flashpoint_id, cluster_id, summary, article_count, coalesce(array_to_string(top_domains, '|'), '') as top_domains, coalesce(len(urls), 0) as n_urls, coalesce(len(images), 0) as n_images, coalesce(len(languages), 0) as n_languages from news_clusters""")
def src24_cluster_sink(spark, d):
    """Cluster rows written with their lists as JSON into a day's partition and read back."""
    path = scratch(spark, "clusters")
    S.init_day(spark, path, "2025-01-01")
    S.store_clusters(_t(spark, d, "news_clusters"), path, "2025-01-01")
    r = S.load_clusters(spark, path, "2025-01-01")
    return r.select("flashpoint_id", "cluster_id", "summary", "article_count", F.array_join("top_domains", "|").alias("top_domains"), *[F.size(c).cast("long").alias(f"n_{c}") for c in ("urls", "images", "languages")])


@_query(rf"""select id, flashpoint_id, trim(regexp_replace(raw_text, '[ \t\r\f\x0B\n]+', ' ', 'g')) as raw_text, trim(regexp_replace(title, '[ \t\r\f\x0B\n]+', ' ', 'g')) as title, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at
    from {_once('flashpoint_id', 'raw_text', 'title', 'created_at')} where flashpoint_id is not null""")
def src25_checkpoint_rows(spark, d):
    """Feeds written as JSON lines for each topic and day, and read back."""
    path = scratch(spark, "checkpoint")
    S.write_checkpoint(_t(spark, d, "feeds").where("flashpoint_id is not null").dropDuplicates(["id"]), path, "2025-01-01")
    r = S.read_checkpoint(spark, path)
    return r.select("id", "flashpoint_id", "raw_text", "title", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


def _collections(spark, d) -> str:
    path = scratch(spark, "collections")
    f = _feeds(spark, d, "flashpoint_id", "url", "image", "domain", "sourcecountry", "language", "raw_text", "summary", "embedding").where("flashpoint_id is not null")
    S.insert_collection(S.collection_rows(f), path)
    return path


_STORED = f"{_once('flashpoint_id', 'raw_text', 'embedding')} where flashpoint_id is not null and len(embedding) > 0 and trim(raw_text) <> ''"


@_query(f"select flashpoint_id, id, len(embedding) as n, raw_text as document from {_STORED}")
def src19_collection_scan(spark, d):
    return S.scan_collection(spark, _collections(spark, d)).select("flashpoint_id", "id", F.size("embedding").cast("long").alias("n"), "document")


@_query(f"select distinct flashpoint_id from {_STORED} and flashpoint_id <> (select min(flashpoint_id) from {_STORED})")
def src21_collections(spark, d):
    """The collections that are left after the first one was deleted."""
    path = _collections(spark, d)
    first = S.list_collections(spark, path).agg(F.min("flashpoint_id").alias("f")).first().f
    if first is not None:
        S.delete_collection(spark, path, first)
    return S.list_collections(spark, path)


@_query("select name, n from (select 'flashpoints' as name, count(*) as n from flashpoints union all select 'clusters', count(*) from news_clusters)")
def src10_written_together(spark, d):
    """Row counts of two tables that were written all or none."""
    at = {name: scratch(spark, name) for name in ("flashpoints", "clusters")}
    counts = S.write_together({at["flashpoints"]: _t(spark, d, "flashpoints").select("id", "title"), at["clusters"]: _t(spark, d, "news_clusters").select("id", "summary")})
    return spark.createDataFrame([(name, counts[path]) for name, path in at.items()], "name string, n long")


@_query("select flashpoint_id, cluster_id, article_count from news_clusters")
def src23_day_recreated(spark, d):
    """A day's partition that was written, dropped, made anew and written once more."""
    path, rows = scratch(spark, "days"), _t(spark, d, "news_clusters")
    for day in ("2025-01-01", "2025-01-02"):
        S.store_clusters(rows, path, day)
    S.init_day(spark, path, "2025-01-02")
    S.store_clusters(rows, path, "2025-01-02")
    S.drop_day(spark, path, "2025-01-01")
    return spark.read.parquet(path).select("flashpoint_id", "cluster_id", "article_count")


@_query()
def src12_main_text(spark, d):
    page = F.concat(F.lit("<html><body><nav>menu</nav><div class='cookie-bar'>We keep cookies.</div><p>"), F.regexp_replace("text", "\n", "</p>\n<p>"), F.lit("</p><footer>end</footer></body></html>"))
    return _t(spark, d, "documents").select("doc_id", H.main_text(page).alias("text"))


# filters and projections


@_query("select id from flashpoints where id in (select flashpoint_id from feeds)")
def f1_nonempty_topics(spark, d):
    return TP.with_feeds(_t(spark, d, "flashpoints"), _t(spark, d, "feeds")).select("id")


@_query("select id from flashpoints p where not exists (select 1 from feeds f where f.flashpoint_id = p.id)")
def f1_empty_topics(spark, d):
    return TP.without_feeds(_t(spark, d, "flashpoints"), _t(spark, d, "feeds")).select("id")


@_query(f"select id, language from {_once('language')} where language is distinct from 'en'")
def f2_non_english(spark, d):
    return _feeds(spark, d, "language").where(TP.not_language(F.col("language")))


@_query(f"select id, raw_text as processed_text from {_once('raw_text')} where length(raw_text) > 0")
def f3_scraped(spark, d):
    return _feeds(spark, d, "raw_text").where(F.length("raw_text") > 0).select("id", F.col("raw_text").alias("processed_text"))


def _re(pattern: str) -> str:
    """A pattern for DuckDB, which knows no look-around: word edges are ASCII there, so texts are matched in their ``_plain`` form."""
    return pattern.replace(X.BEFORE, r"\b").replace(X.AFTER, r"\b").replace("(?md)", "(?m)").replace("(?d)", "")


def _plain(c: str) -> str:
    """A text with letters and figures beyond ASCII as underscores, so that ASCII word edges lie where those of any script do."""
    return rf"regexp_replace({c}, '[\p{{Lo}}\p{{Lm}}\p{{Nl}}\p{{No}}\p{{Cyrillic}}\p{{Greek}}\x{{C0}}-\x{{D6}}\x{{D8}}-\x{{F6}}\x{{F8}}-\x{{24F}}]', '_', 'g')"


def _clean_sql(c: str) -> str:
    for pattern, by in X.CLEAN_STEPS:
        c = f"regexp_replace({c}, '{_re(pattern)}', '{by.replace('$1', chr(92) + '1')}', 'g')"
    return c


_TRIMMED = r"regexp_replace(text, '^[ \t\r\f\x0B\n]+|[ \t\r\f\x0B\n]+$', '', 'g')"


@_query(f"""select doc_id, case when length({_TRIMMED}) >= 1000 then 'primary' when length({_clean_sql('text')}) >= 1500 then 'fallback' else 'dropped' end as route
    from documents where text is not null""")
def f4_accept_len(spark, d):
    trimmed = F.regexp_replace("text", r"^[ \t\r\f\x0B\n]+|[ \t\r\f\x0B\n]+$", "")
    route = F.when(F.length(trimmed) >= 1000, "primary").when(F.length(X.clean(F.col("text"))) >= 1500, "fallback").otherwise("dropped")
    return _t(spark, d, "documents").where("text is not null").select("doc_id", route.alias("route"))


@_query(f"""select id, url, coalesce(nullif(image, ''), 'unknown') as image, domain, sourcecountry, coalesce(nullif(language, ''), 'unknown') as language
    from {_once('url', 'image', 'domain', 'sourcecountry', 'language')}""")
def f9_metadata_defaults(spark, d):
    f = _feeds(spark, d, "url", "image", "domain", "sourcecountry", "language")
    return f.select("id", "url", TP.or_unknown(F.col("image")).alias("image"), "domain", "sourcecountry", TP.or_unknown(F.col("language")).alias("language"))


@_query(f"select doc_id, length({_clean_sql('text')}) as n_chars from documents where length({_TRIMMED}) < 1000 and length({_clean_sql('text')}) >= 1500")
def f6_sequential_fallback(spark, d):
    """Texts that the primary rule drops and the fallback of the sequential path takes."""
    trimmed = F.regexp_replace("text", r"^[ \t\r\f\x0B\n]+|[ \t\r\f\x0B\n]+$", "")
    r = _t(spark, d, "documents").where(F.length(trimmed) < 1000).select("doc_id", F.length(X.clean(F.col("text"))).cast("long").alias("n_chars"))
    return r.where("n_chars >= 1500")


# joins


@_query(f"select p.id as topic, f.id as feed from flashpoints p left join {_once('flashpoint_id')} f on f.flashpoint_id = p.id")
def j1_topic_feed_left(spark, d):
    f = _feeds(spark, d, "flashpoint_id").withColumnRenamed("id", "feed")
    return _t(spark, d, "flashpoints").select(F.col("id").alias("topic")).join(f, F.col("topic") == F.col("flashpoint_id"), "left").select("topic", "feed")


@_query(f"select id, case when language is distinct from 'en' then upper(title) else title end as title from {_once('title', 'language')}")
def j2_merge_back(spark, d):
    f = _feeds(spark, d, "title", "language")
    done = f.where(TP.not_language(F.col("language"))).select("id", F.upper("title").alias("title"))
    return TP.merge_back(f, done, "id", "title").select("id", "title")


@_query("select doc_id, " + "case lower(lang) " + " ".join(f"when '{k}' then '{v}'" for k, v in L.MODEL_CODES.items()) + " else lower(lang) end as code from documents")
def j5_lang_code_map(spark, d):
    return _t(spark, d, "documents").select("doc_id", L.model_code(F.lower("lang")).alias("code"))


@_query("""select a.vec_id as a, b.vec_id as b, round(list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])), 5) as similarity
    from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""")
def j9_pair_cosine(spark, d):
    e = _t(spark, d, "embeddings")
    a, b = e.select(F.col("vec_id").alias("a"), F.col("embedding").alias("ea")), e.select(F.col("vec_id").alias("b"), F.col("embedding").alias("eb"))
    return a.join(b, F.col("b") == F.col("a") + 1).select("a", "b", F.round(C.cosine(F.col("ea"), F.col("eb")), 5).alias("similarity"))


# aggregation

_CLUSTER_ROWS = f"(select flashpoint_id, coalesce(nullif(domain, ''), 'unknown') as domain, coalesce(nullif(language, ''), 'unknown') as language, url, image, created_at, id from {_once('flashpoint_id', 'domain', 'language', 'url', 'image', 'created_at')})"


def _rows(spark, d):
    return _feeds(spark, d, "flashpoint_id", "domain", "language", "url", "image", "created_at")


@_query(f"select flashpoint_id, count(*) as article_count from {_once('flashpoint_id')} group by 1 having count(*) >= 2")
def a2_having_min2(spark, d):
    return _feeds(spark, d, "flashpoint_id").groupBy("flashpoint_id").agg(F.count("*").alias("article_count")).where("article_count >= 2")


_TOP3 = f"""(select flashpoint_id, string_agg(domain, '|' order by n desc, first_at, first_id) as top_domains from (
        select *, row_number() over (partition by flashpoint_id order by n desc, first_at, first_id) as r from (
            select flashpoint_id, domain, count(*) as n, min(created_at) as first_at, arg_min(id, (created_at, id)) as first_id from {_CLUSTER_ROWS} group by 1, 2)) where r <= 3 group by 1)"""


@_query(f"select * from {_TOP3}")
def a4_top3_domains(spark, d):
    t = A.top_values(_rows(spark, d), ["flashpoint_id"], "domain", ["created_at", "id"], 3, "top_domains")
    return t.select("flashpoint_id", F.array_join("top_domains", "|").alias("top_domains"))


@_query(f"""select flashpoint_id, string_agg(distinct language, '|' order by language) as languages, string_agg(distinct domain, '|' order by domain) as domains from {_CLUSTER_ROWS} group by 1""")
def a5_distinct_sorted(spark, d):
    g = _rows(spark, d).groupBy("flashpoint_id").agg(*[F.array_join(F.array_sort(F.collect_set(TP.or_unknown(F.col(c)))), "|").alias(f"{c}s") for c in ("language", "domain")])
    return g.select("flashpoint_id", "languages", "domains")


@_query(f"""select flashpoint_id, string_agg(url, '|' order by created_at, id) as urls from {_CLUSTER_ROWS} where url <> '' group by 1""")
def a6_ordered_urls(spark, d):
    return A.ordered_concat(_rows(spark, d).where("url <> ''"), ["flashpoint_id"], ["created_at", "id"], "url", "|").withColumnRenamed("url", "urls")


@_query(r"""select id, string_agg(line, ' ' order by i) as joined from (
        select id, unnest(string_split(raw_text, chr(10))) as line, generate_subscripts(string_split(raw_text, chr(10)), 1) as i from (select distinct id, raw_text from feeds) where raw_text is not null) group by id""")
def a7_ordered_concat(spark, d):
    lines = _feeds(spark, d, "raw_text").select("id", F.posexplode(F.split("raw_text", "\n")).alias("i", "line"))
    return A.ordered_concat(lines, ["id"], ["i"], "line", " ").select("id", F.col("line").alias("joined"))


@_query(f"""select flashpoint_id, count(*)::integer as article_count, any_value(t.top_domains) as top_domains,
    string_agg(distinct domain, '|' order by domain) as all_domains, string_agg(distinct language, '|' order by language) as languages,
    coalesce(string_agg(url, '|' order by created_at, id) filter (where url not in ('', 'unknown')), '') as urls,
    coalesce(string_agg(image, '|' order by created_at, id) filter (where image not in ('', 'unknown')), '') as images
    from {_CLUSTER_ROWS} r join {_TOP3} t using (flashpoint_id) group by 1 having count(*) >= 2""")
def c11_cluster_records(spark, d):
    r = A.cluster_records(_rows(spark, d), ["flashpoint_id"], ["created_at", "id"])
    return r.select("flashpoint_id", "article_count", *[F.array_join(c, "|").alias(c) for c in ("top_domains", "all_domains", "languages", "urls", "images")])


_WORDS = f"list_filter(regexp_extract_all(lower(s), '{X.WORD}'), lambda w: length(w) >= 2)"
_SENTENCES = rf"""(select doc_id, n, i, s from (select doc_id, len(ss) as n, unnest(ss) as s, generate_subscripts(ss, 1) - 1 as i from (
        select doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([{X.TERMINATORS}])[ \t\r\n]+', '\1' || chr(1), 'g'), chr(1)),
            lambda x: trim(regexp_replace(x, '[ \t\r\f\x0B\n]+', ' ', 'g'))), lambda x: x <> '') as ss from documents where text is not null)))"""
_TERMS = f"""w as (select doc_id, i, n, {_WORDS} as w from {_SENTENCES}),
    uni as (select doc_id, i, n, unnest(w) as term from w),
    bi as (select doc_id, i, n, unnest(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) as term from w where len(w) >= 2),
    tf as (select doc_id, i, n, term, count(*) as tf from (select * from uni union all select * from bi) group by all)"""


def _weights_sql(share: str = "1.0") -> str:
    return f"""{_TERMS},
    df as (select *, count(*) over (partition by doc_id, term) as df from tf),
    raw as (select *, (1 + ln(tf)) * (ln((1.0::double + n) / (1 + df)) + 1) as raw from df where df <= {share}::double * n),
    v as (select doc_id, i, n, term, raw / sqrt(sum(raw * raw) over (partition by doc_id, i)) as v from raw)"""


@_query(f"with {_TERMS} select doc_id, count(distinct term) as n_terms, sum(tf)::bigint as n_tokens from tf group by 1")
def a9_tf_df(spark, d):
    t = Z.terms(Z.sentence_rows(_t(spark, d, "documents")))
    return t.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf")).groupBy("doc_id").agg(F.count("*").alias("n_terms"), F.sum("tf").alias("n_tokens"))


_REDUNDANCY = """r as (select doc_id, case when n >= 3 then greatest((sum(s * s) - max(rows)) / (n * (n - 1.0::double)), 0) else 0.0::double end as redundancy
        from (select doc_id, n, term, sum(v) as s from v group by 1, 2, 3) join (select doc_id, count(distinct i) as rows from v group by 1) using (doc_id) group by doc_id, n)"""


@_query(f"with {_weights_sql()}, {_REDUNDANCY} select doc_id, round(redundancy, 6) as redundancy from r")
def t13_redundancy(spark, d):
    return Z.redundancy(_t(spark, d, "documents")).select("doc_id", F.round("redundancy", 6).alias("redundancy"))


_SCORES = f"""top as (select doc_id, i, max(v) as top from v group by 1, 2),
    sc as (select x.doc_id, x.i, x.n, x.s, regexp_matches({_plain('x.s')}, '{_re(X.DATES)}') as forced,
        0.75::double * coalesce(top, 0) + 0.1::double / sqrt(greatest(len(string_split(x.s, ' ')), 1)) + 0.1::double * regexp_matches(x.s, '[0-9]')::int
        + 0.05::double * (case when x.n > 1 then 1 - 0.15::double * x.i / (x.n - 1) else 1.0::double end) + 0.25::double * regexp_matches({_plain('x.s')}, '{_re(X.DATES)}')::int as score
        from {_SENTENCES} x left join top using (doc_id, i))"""


@_query(f"""with {_weights_sql('0.9')}, {_SCORES} select doc_id, i::integer as i, forced from (
    select *, row_number() over (partition by doc_id order by round(score, 9) desc, i desc) as rank from sc) where rank <= greatest(1, floor(n * 0.3::double)) or forced""")
def w2_topk_sentences(spark, d):
    r = Z.scored(_t(spark, d, "documents"))
    kept = r.select("doc_id", "forced", F.explode(Z.top_k(F.col("score"), F.col("forced"), F.lit(0.3))).alias("i"))
    return kept.select("doc_id", "i", F.element_at("forced", F.col("i") + 1).alias("forced"))


@_query(f"""select doc_id, count(*) as n_kept, max(spent)::bigint as spent from (
    select doc_id, i, sum(length(s)) over (partition by doc_id order by i rows unbounded preceding) as spent from {_SENTENCES}) where spent <= 1000 group by 1""")
def w4_budget_prefix(spark, d):
    s = _t(spark, d, "documents").select("doc_id", F.transform(X.sentences(F.col("text")), F.length).alias("c"))
    n = s.withColumn("n", Z.within_budget(F.col("c"), F.lit(1000))).where("n > 0")
    return n.select("doc_id", F.col("n").cast("long").alias("n_kept"), F.aggregate(F.slice("c", F.lit(1), F.col("n")), F.lit(0).cast("long"), lambda a, x: a + x).alias("spent"))


@_query(f"""with {_weights_sql('0.9')}, {_SCORES}, m as (select *, max(score) over (partition by doc_id) as best from sc)
    select doc_id, count(*) as n_kept from m where round(score, 9) >= round(0.2::double * best, 9) group by 1""")
def f13_score_threshold(spark, d):
    return Z.scored(_t(spark, d, "documents")).select("doc_id", F.size(Z.above(F.col("score"), 0.2)).cast("long").alias("n_kept"))


@_query(f"""with {_weights_sql('0.9')}, {_SCORES} select doc_id, i::integer as i, round((score - low) / (high - low + 0.000000001::double), 6) as scaled from (
    select *, min(score) over (partition by doc_id) as low, max(score) over (partition by doc_id) as high from sc)""")
def w6_min_max(spark, d):
    r = Z.scored(_t(spark, d, "documents")).select("doc_id", F.posexplode(Z.min_max(F.col("score"))).alias("i", "scaled"))
    return r.select("doc_id", "i", F.round("scaled", 6).alias("scaled"))


@_query()
def t14_compress(spark, d):
    return Z.compress(_t(spark, d, "documents"))


def _firsts(pattern: str, name: str, most: int) -> str:
    """The first spellings, at most so many, of the matches of a pattern in each document: (doc_id, v, k) with the place k."""
    return rf"""{name}_all as (select doc_id, unnest(regexp_extract_all({_plain('text')}, '{_re(pattern)}')) as v, generate_subscripts(regexp_extract_all({_plain('text')}, '{_re(pattern)}'), 1) as pos from documents),
    {name} as (select doc_id, v, row_number() over (partition by doc_id order by pos) as k from (
        select *, row_number() over (partition by doc_id, lower(v) order by pos) as r from {name}_all) where r = 1 qualify k <= {most})"""


@_query(f"""with {_firsts(X.CAPITALISED, 'names', 50)}, {_firsts(X.DATES, 'dates', 50)}, both_ as (
        select doc_id, lower(v) as v, k from names union all select doc_id, lower(v), 100 + k from dates where k <= 5),
    once as (select doc_id, v, min(k) as k from both_ group by 1, 2)
    select doc_id, string_agg(v, '|' order by k) as must_keep from (select *, row_number() over (partition by doc_id order by k) as r from once) where r <= 15 group by 1""")
def a12_must_keep(spark, d):
    m = _t(spark, d, "documents").select("doc_id", X.must_keep(X.entities(F.col("text"))).alias("m")).where(F.size("m") > 0)
    return m.select("doc_id", F.array_join("m", "|").alias("must_keep"))


@_query(f"""select doc_id, round(len(list_distinct(b)) / len(b), 6) as ratio from (
    select doc_id, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) as b from (select doc_id, {_WORDS.replace('lower(s)', 'lower(text)')} as w from documents) where len(w) >= 2)""")
def a13_bigram_ratio(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.round(X.unique_bigram_ratio(F.col("text")), 6).alias("ratio")).where("ratio is not null")


_HITS = {k: " + ".join(f"(contains(lower(text), '{w}'))::int" for w in ws) for k, ws in N.DOMAINS.items()}
_BEST = "greatest(" + ", ".join(_HITS.values()) + ")"
_DOMAIN = f"case when {_BEST} = 0 then 'world' " + " ".join(f"when {h} = {_BEST} then '{k}'" for k, h in _HITS.items()) + " end"


@_query(f"select doc_id, {_DOMAIN} as domain from documents where text is not null")
def a14_domain_argmax(spark, d):
    return _t(spark, d, "documents").where("text is not null").select("doc_id", N.domain(F.col("text")).alias("domain"))


# metrics


@_query("""with g as (select event_type, count(*) as requests, count(distinct user_id) as batches, sum((event_type = 'error')::bigint)::bigint as errors, sum(value) as v,
        greatest(floor(epoch(max(ts) - min(ts)))::bigint, 1) as seconds from events group by 1)
    select event_type, requests, errors, batches, round(errors / requests, 6) as error_rate, round(v / requests, 6) as mean_value, round(v / batches, 6) as mean_batch,
        round(requests / seconds, 6) as per_second, round(batches / seconds, 6) as batches_per_second, round(least(1.0::double, requests / seconds / (batches * 10)), 6) as batch_efficiency from g""")
def a15_rates(spark, d):
    return M.rates(_t(spark, d, "events"), "event_type")


_GAUGE = "select event_id, (event_id % 100) / 100.0::double as gpu, (event_id % 97)::double as cpu, (event_id % 11) / 100.0::double as err, (event_id % 13) / 12.0::double as eff, event_id % 150 as queue from events"


def _gauges(spark, d):
    i = F.col("event_id")
    return _t(spark, d, "events").select("event_id", ((i % 100) / 100.0).alias("gpu"), (i % 97).cast("double").alias("cpu"), ((i % 11) / 100.0).alias("err"), ((i % 13) / 12.0).alias("eff"), (i % 150).alias("queue"))


@_query(f"""select event_id, round(greatest(0, least(100, 100 - (case when gpu < 0.7 then (0.7::double - gpu) * 50 else 0 end) - (case when cpu > 80 then (cpu - 80) * 0.5::double else 0 end)
    - (case when err > 0.05 then err * 200 else 0 end) - (case when eff < 0.8 then (0.8::double - eff) * 25 else 0 end))), 6) as score from ({_GAUGE})""")
def a16_health_score(spark, d):
    g = _gauges(spark, d)
    return g.select("event_id", F.round(M.health(F.col("gpu"), F.col("cpu"), F.col("err"), F.col("eff")), 6).alias("score"))


@_query(f"""select event_id, c as category, p as priority from (
    select event_id, unnest(['gpu', 'cpu', 'batching', 'errors', 'queue']) as c, unnest(['high', 'medium', 'medium', 'high', 'medium']) as p,
    unnest([gpu < 0.7::double, cpu > 80, eff < 0.8::double, err > 0.05::double, queue > 100]) as fires from ({_GAUGE})) where fires""")
def a19_recommendations(spark, d):
    g = _gauges(spark, d)
    r = F.explode(M.recommendations(F.col("gpu"), F.col("cpu"), F.col("err"), F.col("eff"), F.col("queue")))
    return g.select("event_id", r.alias("r")).select("event_id", "r.category", "r.priority")


@_query("""select event_id, round(avg(value) over w, 6) as rolling_mean, count(*) over w as rolling_n from events window w as (partition by user_id order by ts, event_id rows between 999 preceding and current row)""")
def w7_rolling_1000(spark, d):
    return M.rolling(_t(spark, d, "events"), "user_id").select("event_id", F.round("rolling_mean", 6).alias("rolling_mean"), "rolling_n")


@_query("""select event_id, round((value - f) / greatest(f, 1), 6) as trend, round((value - f) / greatest(f, 0.001::double), 6) as share_trend, round(case when value <> 0 and f <> 0 then value - f else 0 end, 6) as plain_trend
    from (select *, lag(value, 9) over w as f, row_number() over w as r from events window w as (partition by user_id order by ts, event_id)) where r >= 10""")
def w8_trend10(spark, d):
    t = M.trend(_t(spark, d, "events"), "user_id")
    t = M.trend(M.trend(t, "user_id", floor=M.SHARE_FLOOR, name="share_trend"), "user_id", floor=None, name="plain_trend").where("trend is not null")
    return t.select("event_id", F.round("trend", 6).alias("trend"), F.round("share_trend", 6).alias("share_trend"), F.round("plain_trend", 6).alias("plain_trend"))


# duplicates and ids


@_query(f"with {_firsts(X.CAPITALISED, 'names', 50)} select doc_id, string_agg(v, '|' order by k) as names from names group by 1")
def d4_ci_dedup(spark, d):
    e = _t(spark, d, "documents").select("doc_id", X.entities(F.col("text"))["names"].alias("names"))
    return e.where(F.size("names") > 0).select("doc_id", F.array_join("names", "|").alias("names"))


@_query(f"""with {_firsts(X.CAPITALISED, 'names', 50)}, {_firsts(X.DATES, 'dates', 50)}, {_firsts(X.NUMBERS, 'numbers', 50)}
    select doc_id, (select count(*) from names x where x.doc_id = d.doc_id) as n_names, (select count(*) from dates x where x.doc_id = d.doc_id) as n_dates,
        (select count(*) from numbers x where x.doc_id = d.doc_id) as n_numbers, (select string_agg(v, '|' order by k) from dates x where x.doc_id = d.doc_id) as dates from documents d where text is not null""")
def t19_entities(spark, d):
    e = _t(spark, d, "documents").where("text is not null").select("doc_id", X.entities(F.col("text")).alias("e"))
    return e.select("doc_id", *[F.size(f"e.{c}").cast("long").alias(f"n_{c}") for c in ("names", "dates", "numbers")], F.when(F.size("e.dates") > 0, F.array_join("e.dates", "|")).alias("dates"))


@_query(r"""select doc_id, string_agg(line, chr(10) order by pos) as text from (select doc_id, line, min(pos) as pos from (
        select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents) group by 1, 2) group by 1""")
def d5_line_dedup(spark, d):
    return _t(spark, d, "documents").where("text is not null").select("doc_id", F.array_join(F.array_distinct(F.split("text", "\n")), "\n").alias("text"))


@_query("""select doc_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', (('0x' || h[17:17])::int % 4) + 1, 1) || h[18:20] || '-' || h[21:32] as content_id
    from (select doc_id, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(text)) as h from documents where text is not null)""")
def d7_content_id(spark, d):
    return _t(spark, d, "documents").where("text is not null").select("doc_id", X.content_id(F.col("text")).alias("content_id"))


@_query("select doc_id, sha1(lower(title)) as signature from documents")
def d8_sha1_signature(spark, d):
    return _t(spark, d, "documents").select("doc_id", X.signature(F.col("title")).alias("signature"))


# text


@_query(f"select doc_id, {_clean_sql('text')} as text from documents")
def t1_clean(spark, d):
    return _t(spark, d, "documents").select("doc_id", X.clean(F.col("text")).alias("text"))


@_query()
def t2_paragraphs(spark, d):
    page = F.concat(F.lit("<html><body><nav>menu</nav><p>"), F.regexp_replace("text", "\n", "</p>\n<p>"), F.lit("</p></body></html>"))
    return _t(spark, d, "documents").select("doc_id", H.paragraphs(page).alias("text"))


@_query()
def t4_nfkc(spark, d):
    return _t(spark, d, "documents").select("doc_id", H.nfkc(F.col("text")).alias("text"))


@_query(r"""select doc_id, array_to_string(string_split(regexp_replace(regexp_replace(trim(regexp_replace(text, '[ \t\r\f\x0B\n]+', ' ', 'g')), '^["''–—-] *', ''), '([.!?]) +', '\1' || chr(1), 'g'), chr(1))[1:4], ' ') as summary
    from documents where text is not null""")
def t7_first4_sentences(spark, d):
    return _t(spark, d, "documents").where("text is not null").select("doc_id", X.first_sentences(F.col("text")).alias("summary"))


@_query()
def t8_smart_split(spark, d):
    c = _t(spark, d, "documents").where("text is not null").select("doc_id", X.smart_split(F.col("text"), 412).alias("c"))
    return c.select("doc_id", F.posexplode("c").alias("i", "chunk"))


@_query()
def t10_token_windows(spark, d):
    return K.token_windows(_t(spark, d, "documents")).select("doc_id", F.posexplode("windows").alias("i", "window"))


@_query()
def t11_doc_packing(spark, d):
    f = _feeds(spark, d, "flashpoint_id", "created_at", "domain", "raw_text")
    return K.pack_documents(f, ["flashpoint_id"], ["created_at", "id"], "raw_text", "domain", 1024)


@_query(f"select doc_id, count(*) as n_sentences, sum(length(s))::bigint as n_chars from {_SENTENCES} where length(s) > 20 group by 1")
def t12_sentences(spark, d):
    s = _t(spark, d, "documents").select("doc_id", F.explode(X.sentences(F.col("text"), 20)).alias("s"))
    return s.groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.sum(F.length("s")).alias("n_chars"))


@_query("select event_id, (props->>'$.k')::integer as k from events")
def t23_tolerant_json(spark, d):
    wrapped = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("Here: "), "props", F.lit(" ."))).otherwise(F.col("props"))
    return _t(spark, d, "events").select("event_id", X.tolerant_json(wrapped, "k int")["k"].alias("k"))


@_query()
def t25_language(spark, d):
    return _t(spark, d, "documents").select("doc_id", "lang", L.detect(F.col("text")).alias("language"))


@_query()
def t30_router(spark, d):
    return K.route(_t(spark, d, "documents"), ["source"], ["doc_id"], "text").select("doc_id", "source", "route")


@_query(f"select id, {_TIME}::date as day from {_once('seendate')}")
def t38_dates(spark, d):
    return _feeds(spark, d, "seendate").select("id", X.parse_time(F.col("seendate")).cast("date").alias("day"))


# vectors and clusters


@_query("""select vec_id, round(sqrt(list_inner_product(u, u)), 6) as norm, round(u[1], 6) as first from (
    select vec_id, list_transform(cast(embedding as double[]), lambda x: x / sqrt(list_inner_product(cast(embedding as double[]), cast(embedding as double[])))) as u from embeddings)""")
def c4_l2norm(spark, d):
    u = _t(spark, d, "embeddings").select("vec_id", C.unit(F.col("embedding")).alias("u"))
    return u.select("vec_id", F.round(F.sqrt(C.dot(F.col("u"), F.col("u"))), 6).alias("norm"), F.round(F.col("u")[0], 6).alias("first"))


def _topic_vectors(spark, d):
    f = _feeds(spark, d, "flashpoint_id", "embedding").where((F.size("embedding") == 768) & F.exists("embedding", lambda x: x != 0))
    return f.withColumnRenamed("flashpoint_id", "topic")


@_query()
def c2_kmeans(spark, d):
    return C.label_topics(_t(spark, d, "embeddings").withColumnRenamed("label", "topic"), lambda x: C.kmeans(x, C.auto_k(len(x))), key="vec_id")


@_query()
def c3_density(spark, d):
    return C.label_topics(_t(spark, d, "embeddings").withColumnRenamed("label", "topic"), C.density, key="vec_id")


@_query()
def c7_strategy(spark, d):
    return C.label_topics(_topic_vectors(spark, d))


# streaming transformations on a batch


@_query("select date_trunc('hour', ts) as start, event_type, count(*) as n, round(avg(value), 6) as mean_value from events group by 1, 2")
def st2_tumbling(spark, d):
    return W.tumbling(_t(spark, d, "events")).select("start", "event_type", "n", F.round("mean_value", 6).alias("mean_value"))


@_query("""select user_id, min(ts) as start, count(*) as n from (select *, sum(new) over (partition by user_id order by ts, event_id) as s from (
    select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) < interval 30 minutes then 0 else 1 end as new from events)) group by user_id, s""")
def st3_sessions(spark, d):
    return W.sessions(_t(spark, d, "events"))


# more filters, sets and orders


@_query(f"select id from {_once('flashpoint_id', 'url', 'title')} where id is not null and flashpoint_id is not null and url is not null and title is not null")
def src6_valid_rows(spark, d):
    return S.valid(_feeds(spark, d, "flashpoint_id", "url", "title"), "feed").select("id")


@_query(f"select id, created_at from {_once('created_at')} order by created_at, id limit 50 offset 10")
def o2_page(spark, d):
    return _feeds(spark, d, "created_at").orderBy("created_at", "id").offset(10).limit(50)


@_query(f"select id, flashpoint_id from (select *, row_number() over (partition by flashpoint_id order by created_at, id) as r from {_once('flashpoint_id', 'created_at')}) where r <= 5")
def f14_first_feeds(spark, d):
    w = Window.partitionBy("flashpoint_id").orderBy("created_at", "id")
    return _feeds(spark, d, "flashpoint_id", "created_at").withColumn("r", F.row_number().over(w)).where("r <= 5").select("id", "flashpoint_id")


@_query(f"select url, 'feed' as origin from {_once('url')} union all select url, 'api' as origin from api_articles where url is not null")
def d1_union(spark, d):
    a = _feeds(spark, d, "url").select("url", F.lit("feed").alias("origin"))
    return a.unionByName(_t(spark, d, "api_articles").where("url is not null").select("url", F.lit("api").alias("origin")))


@_query("select distinct url from api_articles where url is not null and url not in (select url from feeds where url is not null)")
def j7_never_scraped(spark, d):
    return _t(spark, d, "api_articles").select("url").where("url is not null").distinct().join(_t(spark, d, "feeds").select("url"), "url", "left_anti")


@_query("""select id, array_to_string(list_transform(list_sort(list_transform(generate_subscripts_list, i -> i)), i -> domains[i]), '|') as domains from (
    select id, domains, list_filter(range(1, len(domains) + 1), lambda i: list_position(domains, domains[i]) = i) as generate_subscripts_list from flashpoints)""".replace("list_transform(list_sort(list_transform(generate_subscripts_list, i -> i)), i -> domains[i])", "list_transform(generate_subscripts_list, lambda i: domains[i])"))
def d6_list_dedup(spark, d):
    return _t(spark, d, "flashpoints").select("id", F.array_join(F.array_distinct("domains"), "|").alias("domains"))


@_query("select label, count(*) as article_count, min(vec_id) as first_id from embeddings where label <> -1 group by 1")
def a1_label_groups(spark, d):
    return _t(spark, d, "embeddings").where("label <> -1").groupBy("label").agg(F.count("*").alias("article_count"), F.min("vec_id").alias("first_id"))


@_query(f"""select flashpoint_id, string_agg('[' || coalesce(nullif(domain, ''), 'unknown') || '] ' || title, ' -- ' order by created_at, id) as text from {_once('flashpoint_id', 'domain', 'title', 'created_at')} where title is not null group by 1""")
def a8_cluster_text(spark, d):
    f = _feeds(spark, d, "flashpoint_id", "domain", "title", "created_at").where("title is not null")
    f = f.withColumn("text", F.concat(F.lit("["), TP.or_unknown(F.col("domain")), F.lit("] "), "title"))
    return A.ordered_concat(f, ["flashpoint_id"], ["created_at", "id"], "text", " -- ")


@_query("select code, name from (select lower(name_en) as code, code3 as name from language_names union all select code, upper(name_en) from language_names)")
def d2_map_merge(spark, d):
    """Two maps merged, the right one winning: code -> English name by code -> upper case, beside English name -> three-letter code."""
    n = _t(spark, d, "language_names")
    left = F.map_from_arrays(F.array("code", F.lower("name_en")), F.array("name_en", "code3"))
    right = F.create_map("code", F.upper("name_en"))
    return n.select(F.explode(TP.merged_map(left, right)).alias("code", "name"))


@_query("select distinct domain from (select unnest(domains) as domain from flashpoints) where domain is not null")
def d3_distinct_values(spark, d):
    return _t(spark, d, "flashpoints").select(F.explode("domains").alias("domain")).where("domain is not null").dropDuplicates(["domain"])


@_query("select string_agg(code || '=' || name_en, ',' order by code) as names from language_names")
def o9_sorted_map(spark, d):
    """The map of languages in the order of its keys; a fixed table of a few rows."""
    entries = F.array_sort(F.collect_list(F.struct("code", "name_en")))
    return _t(spark, d, "language_names").agg(F.array_join(F.transform(entries, lambda x: F.concat(x["code"], F.lit("="), x["name_en"])), ",").alias("names"))


@_query(f"select id, ((row_number() over (partition by flashpoint_id order by created_at, id) - 1) // 48)::integer as batch from {_once('flashpoint_id', 'created_at')} where flashpoint_id is not null")
def o7_fixed_batches(spark, d):
    """Batches of 48 feeds of a topic in order."""
    w = Window.partitionBy("flashpoint_id").orderBy("created_at", "id")
    f = _feeds(spark, d, "flashpoint_id", "created_at").where("flashpoint_id is not null")
    return f.select("id", F.floor((F.row_number().over(w) - 1) / 48).cast("int").alias("batch"))


@_query(f"select count(*) as n, count(*) as n_valid from {_once()}")
def t42_random_ids(spark, d):
    """Random ids of version 4: how many rows have one of the form."""
    ids = _feeds(spark, d).select(F.uuid().alias("u"))
    form = F.col("u").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return ids.agg(F.count("*").alias("n"), F.sum(form.cast("long")).alias("n_valid"))


@_query("""select label % 3 as part, sum((label = -1)::bigint)::bigint as n_noise, count(distinct label) filter (label <> -1) as n_clusters, count(distinct label) filter (label <> -1) = 0 as fallback
    from (select case when vec_id % 7 = 0 then -1 else label end as label from embeddings) group by 1""")
def a18_noise_counts(spark, d):
    e = _t(spark, d, "embeddings").select(F.when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("label")).alias("label"))
    return C.noise_counts(e.withColumn("part", F.col("label") % 3), "part")


@_query("""select id, p::integer as p, entities[p] as entity, domains[p] as domain from (select *, unnest(range(1, greatest(len(entities), len(domains)) + 1)) as p from flashpoints)""")
def j6_zip_by_position(spark, d):
    z = _t(spark, d, "flashpoints").select("id", F.posexplode(TP.zipped(F.col("entities"), F.col("domains"))).alias("p", "z"))
    return z.select("id", (F.col("p") + 1).alias("p"), F.col("z.left").alias("entity"), F.col("z.right").alias("domain"))


@_query()
def o8_chosen(spark, d):
    return _t(spark, d, "flashpoints").select("id", TP.chosen(F.col("domains"), F.col("id")).alias("domain"))


@_query("select code, " + "case code " + " ".join(f"when '{k}' then '{v}'" for k, v in L.MODEL_CODES.items()) + " end as model_code from language_names")
def t28_supported(spark, d):
    return L.supported(spark)


@_query(r"""select doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '^[- ]+|[- ]+$', '', 'g'))), lambda x: x <> '')[1:3], '|') as questions from documents where text is not null""")
def t36_question_lines(spark, d):
    from . import plugins

    return _t(spark, d, "documents").where("text is not null").select("doc_id", F.array_join(plugins.question_lines(F.col("text")), "|").alias("questions"))


@_query("""with recursive e as (select user_id, ts, event_id, row_number() over (partition by user_id order by ts, event_id) as r from events),
    f as (select user_id, ts, event_id, r from e where r = 1
        union all select n.user_id, n.ts, n.event_id, n.r from (select f.user_id, min(e.r) as r from f join e on e.user_id = f.user_id and e.r > f.r and e.ts >= f.ts + interval 300 minutes group by f.user_id, f.r) k join e n on n.user_id = k.user_id and n.r = k.r)
    select user_id, event_id from f""")
def st3_cache_refreshes(spark, d):
    return W.refreshes(_t(spark, d, "events"), "user_id", 300 * 60).select("user_id", "event_id")


@_query("select domain, count(*) as n from (select distinct domain, outlet_name from outlets) group by 1")
def src15_table_rows(spark, d):
    """Rows of a table kept as a page: outlets written as HTML and read back."""
    o = _t(spark, d, "outlets").select(F.concat(F.lit("<table><tr><th>d</th></tr><tr><td>"), "domain", F.lit("</td><td> "), F.regexp_replace("outlet_name", "&", "&amp;"), F.lit("</td></tr></table>")).alias("html"))
    r = o.select(F.explode(H.table_rows(F.col("html"))).alias("r")).select(F.col("r")[0].alias("domain"), F.col("r")[1].alias("n")).distinct()
    return r.groupBy("domain").agg(F.count("*").alias("n"))


@_query()
def t9_chunks(spark, d):
    c = _t(spark, d, "documents").select("doc_id", X.chunk_text(F.col("text"), F.lower("lang"), 500).alias("c"))
    return c.select("doc_id", F.posexplode_outer("c").alias("i", "chunk"))


@_query()
def t12_language_sentences(spark, d):
    s = _t(spark, d, "documents").select("doc_id", X.sentences_in(F.col("text"), F.lower("lang")).alias("s"))
    return s.select("doc_id", F.posexplode("s").alias("i", "sentence"))


@_query(r"""select id, array_to_string(list_transform(entities, lambda x: trim(regexp_replace(x, '[ \t\r\f\x0B\n]+', ' ', 'g'))), '|') as entities, trim(regexp_replace(title, '[ \t\r\f\x0B\n]+', ' ', 'g')) as title from flashpoints""")
def t5_nested_squeeze(spark, d):
    p = _t(spark, d, "flashpoints").select("id", F.struct("title", "entities").alias("r"))
    r = p.select("id", X.squeeze_nested(F.col("r"), p.schema["r"].dataType).alias("r"))
    return r.select("id", F.array_join("r.entities", "|").alias("entities"), "r.title")


@_query()
def t27_translate(spark, d):
    from . import plugins

    return _t(spark, d, "documents").select("doc_id", plugins.translated(F.col("text"), "default", "default").alias("text"))


@_query()
def t29_translate_remotely(spark, d):
    from . import plugins

    return _t(spark, d, "documents").select("doc_id", plugins.translated_remotely(F.col("text"), wait=0.0).alias("text"))


@_query()
def t31_summaries(spark, d):
    from . import pipeline

    return pipeline.summaries(_t(spark, d, "documents"), "doc_id", "text")


@_query()
def t34_cluster_summaries(spark, d):
    """Summaries of the documents of each source from all of them."""
    from . import pipeline

    docs = _t(spark, d, "documents").where("source is not null")
    return pipeline.cluster_summaries(docs.select("source", "doc_id", "text", F.lower("lang").alias("domain")), ["source"], ["doc_id"], "text")


@_query(f"""select doc_id, {_DOMAIN} as domain, sha1(lower(s)) as signature, s as summary from (select doc_id, text, array_to_string(string_split(regexp_replace(regexp_replace(trim(regexp_replace(title, '[ \t\r\f\x0B\n]+', ' ', 'g')), '^["''–—-] *', ''), '([.!?]) +', '\1' || chr(1), 'g'), chr(1))[1:4], ' ') as s
    from (select doc_id, title, title as text from documents where title is not null))""")
def t35_finalised(spark, d):
    """Finaliser of a short text: cleaned after the model, with its meta and signature."""
    r = _t(spark, d, "documents").where("title is not null").select("doc_id", "title", X.first_sentences(F.col("title")).alias("summary"))
    return r.select("doc_id", N.domain(F.col("title")).alias("domain"), X.signature(F.col("summary")).alias("signature"), "summary")


@_query()
def c5_reduced(spark, d):
    return C.reduced(_t(spark, d, "embeddings"), 20, "vec_id")


@_query()
def c6_soft(spark, d):
    return C.soft_topics(_t(spark, d, "embeddings").withColumnRenamed("label", "topic"), key="vec_id")


# more text


def _without_notices(c: str) -> str:
    for pattern in X.NOTICES:
        c = f"regexp_replace({c}, '{pattern}', '', 'g')"
    return c


@_query(rf"""with l as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos from (select doc_id, string_split({_without_notices('text')}, chr(10)) as ls from documents where text is not null)),
    once as (select doc_id, line, min(pos) as pos from (select doc_id, regexp_replace(line, '^[ \t\r\f\x0B]+|[ \t\r\f\x0B]+$', '', 'g') as line, pos from l) where line <> '' group by 1, 2)
    select d.doc_id, coalesce(regexp_replace(string_agg(line, chr(10) order by pos), '[ \t]+', ' ', 'g'), '') as text from (select doc_id from documents where text is not null) d left join once using (doc_id) group by 1""")
def t6_pre_clean(spark, d):
    return _t(spark, d, "documents").where("text is not null").select("doc_id", X.pre_clean(F.col("text")).alias("text"))


@_query(rf"""select doc_id, coalesce(len(regexp_extract_all(text, '{X.TOKEN}')), 0) as tokens, coalesce(len(regexp_extract_all(text, '{X.TOKEN}')), 0) <= 512 as fits from documents where text is not null""")
def t18_token_fit(spark, d):
    n = X.token_count(F.col("text")).cast("long")
    return _t(spark, d, "documents").where("text is not null").select("doc_id", n.alias("tokens"), (n <= 512).alias("fits"))


@_query(f"""with {_weights_sql()}, rs as (select doc_id, i, sum(v) as total from v group by 1, 2),
    sc as (select x.doc_id, x.i, x.n, coalesce(total, 0) + 0.1::double * regexp_matches(x.s, '[0-9]')::int as score from {_SENTENCES} x left join rs using (doc_id, i))
    select doc_id, i::integer as i from (select *, row_number() over (partition by doc_id order by round(score, 9) desc, i desc) as rank from sc) where rank <= greatest(1, floor(n * 0.3::double))""")
def t17_fraction(spark, d):
    a = Z.analysed(_t(spark, d, "documents"))
    score = F.zip_with("s", "total", lambda x, t: t + 0.1 * x.rlike("[0-9]").cast("int"))
    a = a.select("doc_id", score.alias("score"), F.transform("s", lambda x: F.lit(False)).alias("none"))
    return a.select("doc_id", F.explode(Z.top_k(F.col("score"), F.col("none"), F.lit(0.3))).alias("i"))


@_query(f"""select doc_id, i::integer as i, round(case when n > 1 then 1 - 0.15::double * i / (n - 1) else 1.0::double end, 6) as weight from {_SENTENCES}""")
def w5_position_weight(spark, d):
    s = Z.sentence_rows(_t(spark, d, "documents"))
    return s.select("doc_id", "i", F.round(Z.place(F.col("i"), F.col("n")), 6).alias("weight"))


_LOW = "lower(s)"
_GATES = f"""with {_firsts(X.CAPITALISED, 'names', 50)}, {_firsts(X.DATES, 'dates', 50)}, {_firsts(X.NUMBERS, 'numbers', 50)}, both_ as (
        select doc_id, lower(v) as v, k from names union all select doc_id, lower(v), 100 + k from dates where k <= 5),
    once as (select doc_id, v, min(k) as k from both_ group by 1, 2),
    must as (select doc_id, list(v order by k) as m from (select *, row_number() over (partition by doc_id order by k) as r from once) where r <= 15 group by 1),
    src as (select doc_id, (select list(v order by k) from dates x where x.doc_id = d.doc_id) as ds, (select list(v order by k) from numbers x where x.doc_id = d.doc_id) as ns, title as s, coalesce(m, []) as m
        from documents d left join must using (doc_id) where title is not null and text is not null),
    g as (select doc_id, s, m, list_filter(m, lambda e: contains({_LOW}, e)) as present, list_filter(m, lambda e: not contains({_LOW}, e)) as missing,
        regexp_matches({_plain('s')}, '{_re(X.DATES)}') as temporal, coalesce(len(ds), 0) > 0 as has_dates, ds, ns,
        s || case when not regexp_matches({_plain('s')}, '{_re(X.DATES)}') and coalesce(len(ds), 0) > 0 then chr(10) || 'Timeline: ' || ds[1] || ' (source).' else '' end as s1 from src),
    h as (select *, not regexp_matches(s1, '\\b[0-9]') and coalesce(len(ns), 0) > 0 as no_figures from g),
    f as (select *, s1 || case when no_figures then chr(10) || 'Note: Source mentioned figures such as ' || array_to_string(ns[1:3], ', ') || '.' else '' end as s2 from h),
    w as (select *, regexp_extract_all(lower(s2), '[\\p{{L}}\\p{{N}}_]+') as w from f),
    b as (select *, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) as b from w)
    select doc_id, len(present) >= greatest(1, len(m) // 2) as entity_coverage, case when len(present) >= greatest(1, len(m) // 2) then '' else array_to_string(missing[1:10], '|') end as missing,
        temporal, not no_figures as numeric_ok, case when len(w) < 2 then true else len(list_distinct(b)) / len(b) >= 0.6::double end as redundancy_ok, s2 as summary from b"""


@_query(_GATES.replace("\\\\", "\\"))
def t21_quality_gates(spark, d):
    """The gates of a title, as the summary, against the entities of its text."""
    r = _t(spark, d, "documents").where("title is not null and text is not null").withColumn("e", X.entities(F.col("text")))
    g = r.select("doc_id", N.quality_gates(F.col("title"), X.must_keep(F.col("e")), F.col("e")).alias("g"))
    return g.select("doc_id", "g.entity_coverage", F.array_join("g.missing", "|").alias("missing"), "g.temporal", "g.numeric_ok", "g.redundancy_ok", "g.summary")


def _distinct_sql(pattern: str, c: str, most: int) -> str:
    found = f"regexp_extract_all({_plain(c)}, '{_re(pattern)}')"
    return f"array_to_string(list_filter({found}, lambda x, i: list_position({found}, x) = i)[1:{most}], '|')"


@_query(f"""select doc_id, {_DOMAIN} as domain, {_DOMAIN} = 'politics' as politics, {_distinct_sql(N.TOPIC, 'lower(text)', 6)} as topics,
    {_distinct_sql(N.PEOPLE, 'text', 10)} as people, {_distinct_sql(N.ORGS, 'text', 10)} as orgs, {_distinct_sql(N.PLACES, 'text', 10)} as places from documents where text is not null""")
def t22_heuristic_meta(spark, d):
    m = _t(spark, d, "documents").where("text is not null").select("doc_id", N.heuristic_meta(F.col("text")).alias("m"))
    return m.select("doc_id", "m.domain", F.col("m.is_politics_central").alias("politics"), *[F.array_join(f"m.{c}", "|").alias(c.split(".")[-1]) for c in ("topics", "entities.people", "entities.orgs", "entities.places")])


@_query("""select doc_id, lower(coalesce(nullif(source, ''), 'world')) as domain, array_to_string(list_filter(list_transform(string_split(coalesce(title, ''), ','), lambda x: trim(x)), lambda x: x <> '')[1:6], '|') as topics,
    nullif(lang, '') as country from documents""")
def t24_normalised_meta(spark, d):
    raw = F.struct(F.col("source").alias("domain"), F.col("title").alias("topics"), F.struct(F.array("source").alias("people")).alias("entities"), F.struct(F.col("lang").alias("country")).alias("geo"))
    docs = _t(spark, d, "documents")
    m = docs.select("doc_id", N.normalised_meta(F.to_json(raw)).alias("m"))
    return m.select("doc_id", "m.domain", F.array_join("m.topics", "|").alias("topics"), F.col("m.geo.country").alias("country"))


@_query()
def c8_fallback(spark, d):
    return C.label_topics(_topic_vectors(spark, d), lambda x: C.kmeans(x, C.fallback_k(len(x))))


@_query()
def pipeline_records(spark, d):
    from . import pipeline

    return pipeline.run(_t(spark, d, "feeds"), _t(spark, d, "flashpoints"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

