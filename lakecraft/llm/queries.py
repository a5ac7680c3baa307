"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import benchmark_overlaps
from .divergence import source_divergence
from .exactdedup import exact_dedup
from .hardneg import hard_negatives
from .licenses import PHRASES, TEMPLATES, license_scan
from .mixing import mix_sources
from .ngram_join import ngram_jaccard_join
from .secrets import secret_scan
from .shared import documents
from .tokenstore import token_ids
from .toxicity import fit_toxicity, toxicity_scores
from .treeforest import near_duplicate_embeddings
from .urlfilter import host_of, path_of, url_filter
from .warc import warc_round_trip

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity_scores(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(documents(spark, sf_dir), tokenizer_path())


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def _day(number: F.Column) -> F.Column:
    """The start of a day of 2024, counted from 0."""
    return F.timestamp_seconds(number * 86_400 + 1_704_067_200)


def list_history(pages: DataFrame) -> DataFrame:
    """A list for the pages' hosts: entries, removals and renewals by a hash of the host, rules for one domain and for one top-level
    domain, and for each host rules for paths: its first segment, four segments with a host in upper case, and one of other case."""
    first = F.min(F.nullif(path_of(F.col("url")), F.lit(""))).alias("path")
    hosts = pages.groupBy(host_of(F.col("url")).alias("host")).agg(first).where("host <> ''")
    x = F.conv(F.substring(F.md5("host"), 1, 4), 16, 10).cast("int")
    hosts = hosts.withColumn("x", x)
    category = F.get(F.array(F.lit("ads"), F.lit("malware"), F.lit("adult")), F.col("x") % 3)
    event = lambda when, rule, action, category, day: F.when(when, F.struct(rule.alias("rule"), F.lit(action).alias("action"), category.alias("category"), _day(day).alias("listed_at")))
    host, x = F.col("host"), F.col("x")
    events = F.array(
        event(x % 4 == 0, host, "block", category, x % 300),
        event(x % 8 == 0, host, "remove", category, x % 300 + 30 + x % 60),
        event(x % 16 == 0, host, "block", F.lit("repeat"), x % 300 + 120),
        event(x % 5 == 1, F.concat(host, F.lit("/en/")), "block", F.lit("section"), F.lit(50)),
        event(F.col("path").isNotNull() & (x % 3 == 0), F.concat(F.upper(host), "path"), "allow", F.lit("page"), F.lit(80)),
        event(F.col("path").isNotNull() & (x % 3 == 1), F.concat(host, F.upper("path")), "block", F.lit("case"), F.lit(80)),
        event(x % 7 == 2, F.concat(host, F.lit("/en/a/b/c/d")), "allow", F.lit("deep"), F.lit(60)),
    )
    domain = pages.sparkSession.sql("select 'example.net' rule, action, 'domain' category, timestamp_seconds(1704067200 + 86400 * day) listed_at from values ('block', 200), ('allow', 260), ('remove', 330) as t(action, day)")
    top = pages.sparkSession.sql("select 'Example' rule, 'block' action, 'top' category, timestamp_seconds(1704067200 + 86400 * 340) listed_at")
    return hosts.select(F.inline(F.filter(events, lambda e: e.isNotNull()))).unionByName(domain).unionByName(top)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    captures = pages.withColumn("fetched_at", _day(F.pmod(F.pmod(F.col("page_id"), F.lit(366)) * 7919, F.lit(366))))
    return url_filter(captures, list_history(pages))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(documents(spark, sf_dir))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(documents(spark, sf_dir))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_toxicity, op2_mixing, op3_decontamination, op4_warc, op5_token_ids, op6_licenses, op7_url_filter, op8_secrets, op9_ngram_jaccard, op10_exact_dedup, op11_hard_negatives, op12_source_divergence, op13_embedding_near_dedup)}

# The words of every text for DuckDB.
_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_TEMPLATES = ", ".join(f"({k}, '{label}', '{text}')" for k, (label, text) in enumerate(TEMPLATES))
_PHRASES = " ".join(f"when w[i:i + {len(text.split()) - 1}] = {text.split()} then '{label}'" for text, label in PHRASES)

ORACLE_SQL: dict[str, str] = {
    "op6_licenses": f"""
        with d as (select doc_id, {_WORDS} w from documents),
        b as (select doc_id, i - 1 pos, case {_PHRASES} end label from (select doc_id, w, unnest(range(1, len(w) + 1)) i from d)),
        base as (select doc_id, count(*) n, min(pos) lo, max(pos) hi, list(distinct label) labels from b where label is not null group by doc_id),
        t as (select template, label, string_split(x, ' ') w from (values {_TEMPLATES}) v(template, label, x)),
        g as (select template, i - 1 tpos, w[i:i + 3] g from (select template, w, unnest(range(1, len(w) - 2)) i from t)),
        v as (select distinct doc_id, template, pos - tpos diagonal, tpos from (select doc_id, i - 1 pos, w[i:i + 3] g from (select doc_id, w, unnest(range(1, len(w) - 2)) i from d)) x join g on x.g = g.g),
        l as (select *, coalesce(diagonal - lag(diagonal) over (partition by doc_id, template order by diagonal) > 2, true) first from (select distinct doc_id, template, diagonal from v)),
        c as (select doc_id, template, diagonal, sum(cast(first as integer)) over (partition by doc_id, template order by diagonal) span from l),
        s as (select doc_id, template, span, count(distinct q) n from (select doc_id, template, span, unnest(range(tpos, tpos + 4)) q from v join c using (doc_id, template, diagonal)) group by all),
        m as (select doc_id, max(n / len(w)) covered, list(distinct label) filter (n / len(w) >= 0.75) found from s join t using (template) group by doc_id)
        select doc_id, cast(len(w) as bigint) n_words, coalesce(n, 0) n_base, lo first_word, hi last_word, array_to_string(list_sort(coalesce(labels, [])), ',') base_labels,
            array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), coalesce(found, [])))), ',') labels, case when n > 0 then 1.0 else coalesce(covered, 0.0) end::double score
        from d left join base using (doc_id) left join m using (doc_id)""",
    "op9_ngram_jaccard": f"""
        with recursive d as (select doc_id, {_WORDS} w from documents),
        s as (select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) g from d),
        n as (select doc_id, count(*) n from s group by doc_id),
        p as (select a.doc_id a, b.doc_id b, count(*) k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
        l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where k >= 0.8 * (x.n + y.n - k) - 1e-9),
        e as (select a, b from l union all select b, a from l),
        r as (select doc_id a, doc_id b from documents union select r.a, e.b from r join e on r.b = e.a),
        c as (select a doc_id, min(b) class_id from r group by a)
        select doc_id, class_id, (select count(*) from e where e.a = c.doc_id) n_links, doc_id = class_id kept from c""",
    "op4_warc": """
        with p as (select page_id, strlen(coalesce(html, '')) b, sha256(coalesce(html, '')) d from pages),
        f as (select d, min(page_id) m from p where b >= 100 group by d)
        select page_id, cast(b as bigint) payload_bytes, p.d payload_digest,
            case when m is not null and page_id is distinct from m then 'revisit' else 'response' end record_type,
            case when m is not null and page_id is distinct from m then m end refers_to
        from p left join f on p.d = f.d and b >= 100""",
    "op7_url_filter": """
        with c as (
            select page_id, url, timestamp '2024-01-01' + to_days(cast((page_id * 7919) % 366 as integer)) fetched_at,
                regexp_replace(regexp_replace(regexp_replace(regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '\\.$', '') host,
                regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) path
            from pages),
        h as (select host, min(nullif(path, '')) path, cast('0x' || substr(md5(host), 1, 4) as integer) x from c where host <> '' group by host),
        e as (
            select host rule, 'block' action, ['ads', 'malware', 'adult'][x % 3 + 1] category, x % 300 d from h where x % 4 = 0
            union all select host, 'remove', ['ads', 'malware', 'adult'][x % 3 + 1], x % 300 + 30 + x % 60 from h where x % 8 = 0
            union all select host, 'block', 'repeat', x % 300 + 120 from h where x % 16 = 0
            union all select host || '/en', 'block', 'section', 50 from h where x % 5 = 1
            union all select rtrim(host || regexp_replace(path, '/+', '/', 'g'), '/'), 'allow', 'page', 80 from h where path is not null and x % 3 = 0
            union all select rtrim(host || regexp_replace(upper(path), '/+', '/', 'g'), '/'), 'block', 'case', 80 from h where path is not null and x % 3 = 1
            union all select host || '/en/a/b/c/d', 'allow', 'deep', 60 from h where x % 7 = 2
            union all select * from (values ('example.net', 'block', 'domain', 200), ('example.net', 'allow', 'domain', 260), ('example.net', 'remove', 'domain', 330), ('example', 'block', 'top', 340)) t),
        o as (
            select rule, action, category, timestamp '2024-01-01' + to_days(cast(d as integer)) listed_at,
                row_number() over (partition by rule, d order by case action when 'block' then 0 when 'allow' then 1 else 2 end, category desc) k
            from e),
        v as (select *, lead(listed_at) over (partition by rule order by listed_at) until from o where k = 1),
        m as (
            select c.page_id, c.url, c.fetched_at, v.action, v.rule, v.category, v.listed_at,
                row_number() over (partition by c.page_id, c.url order by length(v.rule) desc nulls last, v.rule desc) k
            from c left join v on v.action <> 'remove' and fetched_at >= listed_at and (until is null or fetched_at < until)
                and case when contains(rule, '/') then host || '/' = split_part(rule, '/', 1) || '/' and starts_with(regexp_replace(path || '/', '/+', '/', 'g'), substr(rule, strpos(rule, '/')) || '/')
                    else host = rule or ends_with(host, '.' || rule) end)
        select page_id, url, fetched_at, coalesce(action, 'none') verdict, rule, category, listed_at from m where k = 1""",
    "op10_exact_dedup": """
        with t as (select doc_id, coalesce(text, '') t from documents)
        select doc_id, max(doc_id) over (partition by t) keep_id, count(*) over (partition by t) group_size,
            doc_id is not distinct from max(doc_id) over (partition by t) kept, sha256(t) text_sha256
        from t""",
    "op11_hard_negatives": """
        with e as (
            select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end label, list_transform(embedding, lambda x: floor(256 * x::double)) x
            from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id anchor_id, b.vec_id, a.label = b.label same, cast(list_inner_product(a.x, b.x) as bigint) score from e a join e b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.x) = len(b.x)),
        p as (select anchor_id, vec_id positive_id, score positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
        select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) rank, vec_id negative_id, positive_score, score negative_score
        from p join s using (anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score qualify rank <= 3""",
    "op12_source_divergence": r"""
        with d as (select row_number() over () id, coalesce(text, '') text, coalesce(lang, '') lang, coalesce(source, '') source from documents),
        w as (select id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) term from d),
        v as (select lang, term, count(*) n from w group by all having count(distinct id) >= 10),
        l as (select lang, sum(n)::hugeint total, count(*)::hugeint terms from v group by lang),
        g as (select distinct lang, source from d),
        c as (select lang, source, term, count(*) n from w join v using (lang, term) group by all),
        t as (select lang, source, sum(n)::hugeint total from c group by all),
        p as (
            select g.lang, g.source, v.term, coalesce(c.n, 0) n, v.n lang_n,
                1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * l.terms) p, 1 + (1000000000::hugeint * (v.n + 2)) // (l.total + 2 * l.terms) q
            from g join v using (lang) join l using (lang) left join t on t.lang = g.lang and t.source = g.source left join c on c.lang = g.lang and c.source = g.source and c.term = v.term),
        s as (select x.lang, x.source, y.source item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) value from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all),
        a as (
            select x.lang, x.source, 'pair' part, y.source item, coalesce(s.value, 0) value from g x join g y on x.lang = y.lang and x.source <> y.source left join s on s.lang = x.lang and s.source = x.source and s.item = y.source
            union all select lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) from p where n > 0 and p > q),
        r as (select *, row_number() over (partition by lang, source, part order by value desc, item) rank from a)
        select lang, source, part, item, cast(value as bigint) value, cast(rank as integer) rank from r where part = 'pair' or rank <= 10""",
    "op13_embedding_near_dedup": """
        with recursive e as (
            select vec_id, label, embedding::double[] x from embeddings
            where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l as (select a.vec_id a, b.vec_id b from e a join e b on a.label = b.label and a.vec_id <> b.vec_id and len(a.x) = len(b.x) where list_cosine_similarity(a.x, b.x) >= 0.93),
        r as (select vec_id a, vec_id b from embeddings union select r.a, l.b from r join l on r.b = l.a),
        c as (select a vec_id, min(b) component_id from r group by a)
        select vec_id, (select count(*) from l where l.a = c.vec_id) n_links, component_id, vec_id = component_id kept from c""",
}
