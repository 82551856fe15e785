"""Registered queries of the operators, and their SQL."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierworks.llm import (
    ann, bpe, collocations, html_text, license_scan, line_dedup, near_dedup, packing, periodic_runs, piece_bpe, quality_cascade,
    token_codes, warc,
)
from tierworks.llm.common import table
from tierworks.session import work_dir

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-codes")
    token_codes.write_codes(table(spark, sf_dir, "documents"), path)
    return token_codes.read_codes(spark, path).drop("ids")


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op8_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op4_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    features = quality_cascade.measured(docs)
    order = quality_cascade.estimate_order(features, quality_cascade.RULES, known=base)
    judged = quality_cascade.cascade(features, tuple(order), known=base, ordered=False)
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    return judged.select("doc_id", *base, failed.alias("base_failed"), (~failed & F.col("failed_rule").isNull()).alias("kept"))


ORACLE_SQL["op4_quality_cascade"] = r"""
with t as (select doc_id, coalesce(text, '') as text from documents),
w as (
    select doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from t
),
g as (
    select *, case when len(words) < 5 then [] else list_transform(
        range(1, len(words) - 3), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3] || ' ' || words[i + 4]
    ) end as grams
    from w
),
u as (select row_number() over () as row, * from g),
e as (select row, unnest(grams) as gram, unnest(range(1, len(grams) + 1)) as pos from u),
d as (select row, pos from (select *, count(*) over (partition by row, gram) as n from e) where n > 1),
r as (
    select row, sum(least(5, coalesce(next - pos, 5))) as n
    from (select *, lead(pos) over (partition by row order by pos) as next from d) group by row
),
f as (
    select u.doc_id, len(words)::bigint as n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words,
        len(lines) as n_lines, len(regexp_extract_all(text, '[A-Z]')) as n_capitals, len(regexp_extract_all(text, '!')) as n_marks
    from u left join r using (row)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    not (n_words < 10 or 100 * n_repeat_words > 20 * n_words or 10 * n_symbols > n_words
        or word_chars < 2 * n_words or word_chars > 15 * n_words or 10 * n_capitals > 3 * word_chars
        or 5 * n_marks > n_words or (n_lines > 3 and 10 * n_dup_lines > 5 * n_lines)) as kept
from f
"""


@query
def op5_hyper_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


ORACLE_SQL["op5_hyper_min_hash"] = r"""
with recursive d as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
    from documents
),
s as (
    select doc_id, list_distinct(case when len(words) < 2 then words
        else list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) end) as held
    from d
),
e as (select doc_id, unnest(held) as shingle from s),
p as (select a.doc_id as x, b.doc_id as y, count(*) as shared from e a join e b using (shingle) where a.doc_id < b.doc_id group by 1, 2),
l as (
    select x, y from p join s a on x = a.doc_id join s b on y = b.doc_id
    where 100 * shared >= 80 * (len(a.held) + len(b.held) - shared)
),
m as (select x, y from l union all select y, x from l),
r as (select x, y from m union select r.x, m.y from r join m on r.y = m.x),
c as (select x as doc_id, min(y) as least from r group by x)
select doc_id, len(held)::bigint as n_shingles, least(doc_id, coalesce(c.least, doc_id)) as component_id,
    doc_id <= coalesce(c.least, doc_id) as kept
from s left join c using (doc_id)
"""


@query
def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    warc.write_warc(warc.responses(table(spark, sf_dir, "pages")), path)
    derived = warc.derive(warc.read_warc(spark, path))
    head = lambda name: F.col("headers")[name]
    return derived.select(
        head("X-Source-Row").cast("bigint").alias("page_id"), head("WARC-Type").alias("warc_type"),
        head("WARC-Record-ID").alias("record_id"), head("WARC-Refers-To").alias("refers_to"),
        head("WARC-Concurrent-To").alias("concurrent_to"), head("WARC-Target-URI").alias("target_uri"),
        head("X-Source-Payload-Digest").alias("source_payload_digest"),
        head("X-Source-Content-Type").alias("source_content_type"), head("WARC-Block-Digest").alias("block_digest"),
        head("Content-Type").alias("content_type"), head("Content-Length").cast("bigint").alias("content_length"),
        F.col("block").cast("string").alias("block"),
    )


@query
def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@query
def op10_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), "id % 100 = 0")


ORACLE_SQL["op10_inverted_multi_index"] = """
with v as (
    select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
    where vec_id is not null and embedding is not null
        and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
        and list_bool_or(list_transform(embedding, lambda x: x <> 0))
),
d as (
    select q.vec_id as query_id, v.vec_id, sqrt(list_sum(list_transform(list_zip(q.e, v.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) as score
    from v q join v on q.vec_id % 100 = 0 and q.vec_id <> v.vec_id
),
r as (select *, row_number() over (partition by query_id order by score, vec_id)::int as rank from d)
select query_id, rank, vec_id, score from r where rank <= 10
"""


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(docs, count_col="n_deleted")


ORACLE_SQL["op6_line_dedup"] = r"""
with d as (select doc_id, text, string_split(text, chr(10)) as parts from documents),
l as (select doc_id, unnest(parts) as line, unnest(range(1, len(parts) + 1)) as pos from d where text is not null),
w as (
    select *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n,
        row_number() over (partition by doc_id order by pos) as k
    from l where regexp_matches(line, '[^\x20\x09-\x0D]')
),
s as (select *, sum(n) over (partition by doc_id order by k) as total from w),
runs as (
    select a.doc_id, a.k as low, min(b.k) as high from s a join s b using (doc_id)
    where b.k >= a.k and b.total - a.total + a.n >= 50 group by all
    union
    select b.doc_id, max(a.k) as low, b.k as high from s a join s b using (doc_id)
    where b.k >= a.k and b.total - a.total + a.n >= 50 group by all
),
listed as (select doc_id, list(line order by k) as held from w group by doc_id),
keyed as (select r.*, array_to_string(held[low:high], chr(10)) as run from runs r join listed using (doc_id)),
later as (select *, row_number() over (partition by run order by doc_id, low) as turn from keyed),
gone as (select distinct doc_id, unnest(range(low, high + 1)) as k from later where turn > 1),
-- lines without words go with the line before them
held as (
    select l.doc_id, l.pos, l.line, coalesce(max(w.k) over (partition by l.doc_id order by l.pos rows between unbounded preceding and current row), 0) as k
    from l left join w using (doc_id, pos)
),
kept as (
    select h.doc_id, string_agg(h.line, chr(10) order by h.pos) filter (g.k is null) as text
    from held h left join gone g using (doc_id, k) group by h.doc_id
)
select d.doc_id, case when d.text is not null then coalesce(kept.text, '') end as text,
    coalesce(c.n, 0)::bigint as n_deleted
from d left join kept using (doc_id) left join (select doc_id, count(*) as n from gone group by doc_id) c using (doc_id)
"""


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("blocks")


def _license_sql() -> str:
    """Every window against every template, and every word against every phrase."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    phrases = ", ".join(
        f"({k}, '{label}', {quoted(p.split())})" for k, (p, label) in enumerate(license_scan.PHRASES.items())
    )
    templates = ", ".join(
        f"({k}, '{label}', {quoted(license_scan.template_words(wording))}, {n + license_scan.slack(n)}, {license_scan.slack(n)})"
        for k, (label, wording) in enumerate(license_scan.TEMPLATES) for n in [license_scan.template_length(wording)]
    )
    lower = f"translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}')"
    return f"""
with d as (select row_number() over () as row, doc_id, {lower} as text from documents),
w as (select row, doc_id, text, regexp_extract_all(text, '{word}') as words from d),
phrase(no, label, parts) as (values {phrases}),
template(no, label, parts, width, step) as (values {templates}),
e as (select row, words, unnest(range(1, len(words) + 1)) as i from w),
p as (
    select e.row, i - 1 as place, label
    from e join phrase on words[i] = parts[1] and words[i:i + len(parts) - 1] = parts
),
b as (
    select row, count(*) as n_base, min(place) as first_word, max(place) as last_word,
        array_to_string(list_sort(list(distinct label)), ',') as base_labels, list(distinct label) as found
    from p group by row
),
-- only documents that hold enough of a template's words anywhere can hold them in one window
c as (
    select row, words, label, parts, width, step
    from w join template on 100 * len(list_intersect(list_distinct(words), parts)) >= {license_scan.PERCENT} * len(parts)
),
x as (select *, unnest(range(1, len(words) + 1, step)) as i from c),
m as (
    select row, label, len(list_intersect(words[i:i + width - 1], parts)) / len(parts) as containment
    from x where 100 * len(list_intersect(words[i:i + width - 1], parts)) >= {license_scan.PERCENT} * len(parts)
),
t as (select row, list(distinct label) as more, max(containment) as best from m group by row)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
    last_word::bigint as last_word, coalesce(base_labels, '') as base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(found, []), coalesce(more, [])))), ',') as labels,
    case when n_base > 0 then 1.0::double else coalesce(best, 0.0)::double end as score
from w left join b using (row) left join t using (row)
"""


ORACLE_SQL["op3_license_scan"] = _license_sql()


@query
def op13_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = piece_bpe.encode_documents(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def planted_run(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one in ten documents with a run planted in them, as fixed by the task; null ids are left alone."""
    n = len(words)
    if not n or doc_id is None:
        return words
    g, last = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if last:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]


@query
def op12_basic_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted_run)
    best = F.expr(
        "array_sort(runs, (x, y) -> case when x.length * y.period > y.length * x.period then -1"
        " when x.length * y.period < y.length * x.period then 1 when x.start < y.start then -1 when x.start > y.start then 1"
        " when x.period < y.period then -1 when x.period > y.period then 1 else 0 end)[0]"
    )
    listed = F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')), '')")
    return found.withColumns({"best": F.when(F.size("runs") > 0, best), "listed": listed}).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op11_phrase_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op11_phrase_growth"] = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
),
split as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
total as (select lang, sum(len(words))::bigint as n from split group by lang),
word as (select lang, words, unnest(range(1, len(words) + 1)) as i from split),
part as (
    select lang, size, array_to_string(words[i:i + size - 1], ' ') as phrase, count(*) as a
    from word, range(1, 6) as s(size) where i + size - 1 <= len(words) group by all having count(*) >= 100
),
cut as (
    select p.*, string_split(phrase, ' ') as held, unnest(range(1, size)) as k from part p where size > 1
),
scored as (
    select c.lang, c.phrase, c.size, c.a, c.k, x.a as l, y.a as r, n,
        (1000::hugeint * c.a * n // (x.a::hugeint * y.a))::bigint as score
    from cut c join total using (lang)
    join part x on x.lang = c.lang and x.phrase = array_to_string(held[:k], ' ')
    join part y on y.lang = c.lang and y.phrase = array_to_string(held[k + 1:], ' ')
),
lowest as (select *, row_number() over (partition by lang, phrase order by score, k) as turn from scored),
gone as (
    select distinct p.lang, array_to_string(string_split(p.phrase, ' ')[i:i + w - 1], ' ') as phrase, p.a
    from part p, range(1, 5) as f(i), range(2, 5) as v(w) where w < p.size and i + w - 1 <= p.size
),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
    from lowest anti join gone using (lang, phrase, a) where turn = 1
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""
