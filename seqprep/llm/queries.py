"""Registered queries of the training-data operators and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.common import scratch_path, table, tokenizer_path
from seqprep.llm.dedup import exact_dedup
from seqprep.llm.fingerprint import fingerprint_documents, with_classes
from seqprep.llm.infill import fill_in_middle, restored
from seqprep.llm.license import TEMPLATES, scan_licenses
from seqprep.llm.lm import score_documents, train
from seqprep.llm.mixing import mix_sources
from seqprep.llm.packing import pack_documents
from seqprep.llm.periods import collapse_runs
from seqprep.llm.quality import fit_quality, score_quality
from seqprep.llm.repeats import remove_repeats
from seqprep.llm.simhash import hex64, simhash_dedup
from seqprep.llm.tokens import token_index, write_token_files
from seqprep.llm.urlfilter import domain_key, host_of, judge_captures, path_key, url_key

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def fold(folds: int) -> Column:
    """crc32 of the document id as text, modulo ``folds``."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


@query("op2_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and the class of
    documents that links of likeness 0.8 or more connect it with."""
    return with_classes(fingerprint_documents(table(spark, sf_dir, "documents")))


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(4) == 2
    field = fit_quality(docs, table(spark, sf_dir, "labels"), learn=~held_out)
    scored = score_quality(docs.select("doc_id", held_out.alias("held_out"), "text"), field)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op1_mixing", r"""
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             substr(md5('7|' || coalesce(doc_id::VARCHAR, '')), 1, 15) AS h
      FROM documents),
    s AS (
      SELECT source, sum(size)::BIGINT AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k
      FROM d GROUP BY source),
    w AS (SELECT *, CASE k % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
    l AS (
      SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0))::DOUBLE
                / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::DOUBLE AS lev
      FROM w WINDOW o AS (ORDER BY (3 * source_size) / weight, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    t AS (
      SELECT source, source_size, least((3 * source_size)::DOUBLE, max(lev) OVER () * weight) AS target FROM l),
    p AS (
      SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS quota,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    e AS (
      SELECT *, greatest(0, least(size, quota - start)) AS a, greatest(0, least(size, quota - start - source_size)) AS b,
             greatest(0, least(size, quota - start - 2 * source_size)) AS c
      FROM p)
    SELECT doc_id, size::BIGINT AS size, source_size, target, (a + b + c)::BIGINT AS taken,
           ((a > 0)::INT + (b > 0)::INT + (c > 0)::INT)::BIGINT AS pieces
    FROM e""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's part in the mix; a piece counts once it has a shard."""
    pieces = mix_sources(table(spark, sf_dir, "documents"), cycle=(5, 2, 1), cap=3)
    return pieces.groupBy("_file", "_row", F.col("id").alias("doc_id"), "size", "source_size", "target").agg(
        F.coalesce(F.sum(F.when(F.col("shard").isNotNull(), F.col("words"))), F.lit(0)).alias("taken"),
        F.count("shard").alias("pieces"),
    ).drop("_file", "_row")


@query("op4_lm_scores")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the trie learnt from nine tenths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(10) == 0
    model = train(docs.filter(~held_out))
    scores = score_documents(docs, model, keep={"held_out": held_out})
    return scores.withColumnRenamed("id", "doc_id").select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op5_simhash_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of three-word shingles, linked at two bits, for every document."""
    classes = simhash_dedup(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return classes.select(F.col("id").alias("doc_id"), hex64(F.col("fp")).alias("fingerprint"), "component_id")


# Seconds since 1970: the pages' crawl year begins, and a day.
YEAR_START, DAY = 1_704_067_200, 86_400
LISTED = "(adult|casino|ads-|spam|pills|bets)"


def spread(value: Column, upto: int) -> Column:
    """A number below ``upto`` from the value's MD5."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 7), 16, 10).cast("long") % upto


def list_history(pages: DataFrame) -> DataFrame:
    """Dated list entries drawn from the pages themselves: domains with listed
    names come, go and come back; a folder of every mobile host and every
    tracked URL come once."""
    urls = pages.select("url").distinct()
    hosts = urls.select(host_of(F.col("url")).alias("host")).filter("host <> ''").distinct()
    domains = hosts.filter(F.col("host").rlike(LISTED)).select(F.regexp_replace("host", "^(www|m|blog)[.]", "").alias("host")).distinct()
    first = F.lit(YEAR_START) + spread(F.col("host"), 200) * DAY
    turns = F.explode(F.array(*[F.struct((first + days * DAY).alias("at"), F.lit(action).alias("action")) for days, action in ((0, "add"), (60, "remove"), (120, "add"))]))
    of_domains = domains.select(domain_key(F.col("host")).alias("key"), turns.alias("t")).select("key", "t.at", "t.action")
    folder = path_key(F.col("host"), F.lit("/en/"))
    of_folders = hosts.filter("host like 'm.%'").select(folder.alias("key"), (F.lit(YEAR_START) + spread(folder, 365) * DAY).alias("at"), F.lit("add").alias("action"))
    key = url_key(F.col("url"))
    of_urls = urls.filter("url like '%utm_source=%'").select(key.alias("key"), (F.lit(YEAR_START) + spread(key, 365) * DAY).alias("at"), F.lit("add").alias("action"))
    return of_domains.unionByName(of_folders).unionByName(of_urls)


@query("op6_url_filters", r"""
    WITH p AS (
      SELECT page_id, url,
             1704067200 + ('0x' || substr(md5(page_id::VARCHAR), 1, 7))::BIGINT % 31536000 AS fetched,
             lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
             regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path0,
             regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)', 1) AS rest
      FROM pages),
    q AS (SELECT *, CASE WHEN path0 = '' THEN '/' ELSE path0 END AS path, 'u:' || host || rest AS ukey FROM p),
    h AS (SELECT DISTINCT host FROM q WHERE host <> ''),
    dom AS (SELECT DISTINCT regexp_replace(host, '^(www|m|blog)[.]', '') AS host FROM h
            WHERE regexp_matches(host, '(adult|casino|ads-|spam|pills|bets)')),
    hist AS (
      SELECT 'd:' || host AS key, 1704067200 + ('0x' || substr(md5(host), 1, 7))::BIGINT % 200 * 86400 + days * 86400 AS ts, action
      FROM dom, (VALUES (0, 'add'), (60, 'remove'), (120, 'add')) t(days, action)
      UNION ALL
      SELECT 'p:' || host || '/en/', 1704067200 + ('0x' || substr(md5('p:' || host || '/en/'), 1, 7))::BIGINT % 365 * 86400, 'add'
      FROM h WHERE host LIKE 'm.%'
      UNION ALL
      SELECT DISTINCT ukey, 1704067200 + ('0x' || substr(md5(ukey), 1, 7))::BIGINT % 365 * 86400, 'add'
      FROM q WHERE url LIKE '%utm_source=%'),
    iv AS (SELECT key, ts AS since, action, lead(ts) OVER (PARTITION BY key ORDER BY ts, action) AS until FROM hist),
    keys AS (
      SELECT page_id, fetched, 'd:' || host AS key FROM q
      UNION SELECT page_id, fetched, 'd:' || regexp_replace(host, '^[^.]*[.]', '') FROM q WHERE len(string_split(host, '.')) > 2
      UNION SELECT page_id, fetched, 'd:' || regexp_replace(host, '^[^.]*[.][^.]*[.]', '') FROM q WHERE len(string_split(host, '.')) > 3
      UNION SELECT page_id, fetched, 'p:' || host || '/' FROM q
      UNION SELECT page_id, fetched, 'p:' || host || regexp_extract(path, '^/[^/]*/') FROM q WHERE path LIKE '/%/%'
      UNION SELECT page_id, fetched, 'p:' || host || path FROM q
      UNION SELECT page_id, fetched, ukey FROM q),
    hits AS (
      SELECT k.page_id, k.key, iv.since FROM keys k JOIN iv USING (key)
      WHERE iv.action = 'add' AND k.fetched >= iv.since AND (iv.until IS NULL OR k.fetched < iv.until)),
    best AS (SELECT page_id, key, since, row_number() OVER (PARTITION BY page_id ORDER BY key, since) AS r FROM hits)
    SELECT q.page_id, q.fetched, best.key IS NOT NULL AS blocked, best.key AS rule, best.since AS since
    FROM q LEFT JOIN best ON q.page_id = best.page_id AND best.r = 1""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries active when it was fetched. The
    tables hold no fetch times or lists, so both are drawn from the pages."""
    pages = table(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", (F.lit(YEAR_START) + spread(F.col("page_id"), 365 * DAY)).alias("fetched"))
    return judge_captures(captures, list_history(pages)).withColumnRenamed("id", "page_id")


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-ID files of every document, read back."""
    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=2)
    return token_index(spark, path)


@query("op8_exact_dedup", r"""
    WITH d AS (
      SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
      FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact deduplication of every document."""
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0, capacity=1024)


_TEMPLATE_ROWS = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES.items())


@query("op9_license_scan", rf"""
    WITH raw_t(name, txt) AS (VALUES {_TEMPLATE_ROWS}),
    t AS (SELECT name, string_split(trim(regexp_replace(lower(txt), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM raw_t),
    tb AS (SELECT DISTINCT name, w[i] || ' ' || w[i + 1] AS b
           FROM (SELECT name, w, unnest(generate_series(1, len(w) - 1)) AS i FROM t)),
    tn AS (SELECT name, count(*) AS n FROM tb GROUP BY name),
    l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS no
          FROM documents),
    n AS (SELECT doc_id, no, trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g')) AS s FROM l),
    lw AS (SELECT doc_id, no, string_split(s, ' ') AS w FROM n WHERE s <> ''),
    lb AS (SELECT DISTINCT doc_id, no, w[i] || ' ' || w[i + 1] AS b
           FROM (SELECT doc_id, no, w, unnest(generate_series(1, len(w) - 1)) AS i FROM lw WHERE len(w) BETWEEN 2 AND 60)),
    ln AS (SELECT doc_id, no, count(*) AS n FROM lb GROUP BY doc_id, no),
    shared AS (SELECT lb.doc_id, lb.no, tb.name, count(*) AS c FROM lb JOIN tb USING (b) GROUP BY lb.doc_id, lb.no, tb.name),
    d AS (SELECT s.doc_id, s.no, s.name, 2.0::DOUBLE * s.c / (ln.n + tn.n) AS dice
          FROM shared s JOIN ln USING (doc_id, no) JOIN tn USING (name)),
    m AS (SELECT *, row_number() OVER (PARTITION BY doc_id, no ORDER BY dice DESC, name) AS r FROM d WHERE dice >= 0.8),
    g AS (SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, max(dice) AS best
          FROM m WHERE r = 1 GROUP BY doc_id)
    SELECT documents.doc_id, coalesce(g.n_matches, 0)::BIGINT AS n_matches, coalesce(g.licenses, '') AS licenses, g.best
    FROM documents LEFT JOIN g ON documents.doc_id = g.doc_id""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in the lines of every document."""
    found = scan_licenses(table(spark, sf_dir, "documents"), least=0.8)
    return found.select(F.col("id").alias("doc_id"), "n_matches", "licenses", "best")


@query("op11_repeated_strings")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that start twice."""
    cut = remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return cut.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """Every tenth document (by the crc32 of its id) with the words from one
    place on replaced by a block of them over and over."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    n = F.size("_words")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    block = F.slice("_words", a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    changed = docs.withColumn("_words", F.when(h % 10 == 0, words))
    return changed.withColumn(
        "text", F.when(n > 0, F.array_join(F.concat(F.slice("_words", F.lit(1), a), tail), " ")).otherwise(F.col("text"))
    ).drop("_words")


@query("op12_periodic_runs", r"""
    WITH h0 AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l,
             list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
               lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
               4294967295) AS c
      FROM documents),
    h1 AS (SELECT doc_id, l, len(l) AS n, xor(c, 4294967295) AS h FROM h0),
    h2 AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a, 3 + (h // 10) % 8 AS e FROM h1),
    h3 AS (SELECT *, 1 + (n - a) // e AS p FROM h2),
    w AS (SELECT doc_id, n, i, CASE WHEN i < a THEN l[i + 1] ELSE l[a + (i - a) % p + 1] END AS w
          FROM (SELECT *, unnest(range(n)) AS i FROM h3)),
    m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM w x JOIN w y
          ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND y.i - x.i <= x.n // 4),
    g AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS grp FROM m),
    s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM g GROUP BY doc_id, q, grp),
    r AS (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
    best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS k FROM r),
    lists AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t
              FROM r GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
    kept AS (SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS t FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY w.doc_id)
    SELECT d.doc_id, coalesce(lists.n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length,
           best.period::BIGINT AS period, (1000 * best.length // best.period)::BIGINT AS exponent_milli,
           sha256(coalesce(lists.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
    FROM documents d LEFT JOIN lists ON d.doc_id = lists.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
    LEFT JOIN best ON d.doc_id = best.doc_id AND best.k = 1""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of the words of every document, and the text without their
    repeats."""
    found = collapse_runs(with_repeated_tail(table(spark, sf_dir, "documents")))
    # of equal quotients the first in order stays
    best = F.aggregate(
        F.slice("runs", 2, 1 << 30), F.get("runs", 0),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


@query("op13_infill", r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
             sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
      FROM documents),
    c AS (
      SELECT *, len(l) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(l) + 1) AS k1, ('0x' || substr(h, 9, 8))::BIGINT % (len(l) + 1) AS k2,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                       OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
                  WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
      FROM d),
    p AS (
      SELECT *, array_to_string(l[1:least(k1, k2)], '') AS prefix, array_to_string(l[least(k1, k2) + 1:greatest(k1, k2)], '') AS middle,
             array_to_string(l[greatest(k1, k2) + 1:], '') AS suffix
      FROM c)
    SELECT doc_id, n::BIGINT AS n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged to fill in a middle of whole lines, and the
    text rebuilt from the output."""
    done = fill_in_middle(table(spark, sf_dir, "documents"), seed=7, rate=100, spm_rate=50)
    back = restored(F.col("output"), F.col("form"))
    return done.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )
