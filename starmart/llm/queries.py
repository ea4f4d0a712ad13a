"""One query for each operator over the whole of its table, and the SQL of those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import (
    bpe, fill_in_middle, filter_audit, jaccard, licenses, merkle, mixing, pages, quality, repeats, substrings, token_files, toxicity,
)
from starmart.llm.common import new_folder

VOCABULARY = "word_bpe_49k.json"
END_ID = 2


def vocabulary() -> str:
    """The vocabulary file of the queries."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token files and read starts, lengths and checksums back."""
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(_read(spark, sf_dir, "documents"), folder, vocabulary(), END_ID)
    return token_files.read_tokens(spark, folder, crc=True)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150% takes of each document, sources weighed 3, 1, 2 in turn."""
    mixed = mixing.mix(_read(spark, sf_dir, "documents"), (3, 1, 2), 1.5, 2.0, keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


OP2_SQL = """
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents
), s as (
  select source, sum(size)::bigint as source_size from d group by source
), w as (
  select *, 2.0::double * source_size as cap,
    list_extract([3, 1, 2], ((row_number() over (order by source nulls last) - 1) % 3 + 1)::int) as weight
  from s
), r as (
  select *, row_number() over o as place,
    (1.5::double * (sum(source_size) over ())::double - coalesce((sum(cap) over (o rows between unbounded preceding and 1 preceding)), 0.0))
    / (sum(weight) over (o rows between current row and unbounded following))::double as each
  from w window o as (order by cap / weight, source nulls last)
), f as (
  select min(place) as first_place, arg_min(each, place) as each from r where each * weight <= cap
), t as (
  select r.source, source_size, case when place >= first_place then f.each * weight else cap end as target,
    ('0x' || substr(md5('0:' || coalesce('s' || source, 'n')), 1, 5))::bigint / 1048576.0::double as u
  from r left join f on true
), p as (
  select d.doc_id, d.size, t.source_size, t.target, t.u,
    case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as rate,
    row_number() over (partition by d.source order by d.size, d.doc_id nulls first) - 1 as pos
  from d join t on d.source is not distinct from t.source
), c as (
  select *, (floor(rate * (pos + 1) + u) - floor(rate * pos + u))::bigint as copies from p
)
select doc_id, size, source_size, target, copies * size as taken, copies from c
"""


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, _read(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", toxicity.held_out(scored["doc_id"]).alias("held_out"), "score", "predicted", "evidence")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that 13-word windows of smaller documents leave."""
    return substrings.dedupe(_read(spark, sf_dir, "documents"), digests=True)


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that no repeated 200-byte string covers."""
    return repeats.dedupe(_read(spark, sf_dir, "documents"), digests=True)


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return pages.extract(_read(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and perplexity verdict of all documents."""
    return quality.assess(_read(spark, sf_dir, "documents"))


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint all documents, their edited texts, and compare both with the next document."""
    return merkle.compare_with_edited(_read(spark, sf_dir, "documents"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under Jaccard similarity of 5-word shingles."""
    return jaccard.join(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents."""
    return bpe.encode_decode(_read(spark, sf_dir, "documents"), vocabulary(), digests=True)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle forms of all documents, as counts and digests."""
    return fill_in_middle.fill_in_middle(_read(spark, sf_dir, "documents"), digests=True)


OP11_SQL = """
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
    sha256('1:' || coalesce(doc_id::varchar, '')) as h
  from documents
), n as (
  select *, len(u)::bigint as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
    ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
  from d
), c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from n
), p as (
  select *, coalesce(array_to_string(u[1:a], ''), '') as x, coalesce(array_to_string(u[a + 1:b], ''), '') as m,
    coalesce(array_to_string(u[b + 1:], ''), '') as y
  from c
)
select doc_id, n, form, case when form <> 'plain' then length(x)::bigint end as prefix_chars,
  case when form <> 'plain' then length(m)::bigint end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || x || '<S>' || y || '<M>' || m
    else '<S>' || y || '<P>' || x || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from p
"""


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all documents."""
    found = licenses.scan(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


_TEMPLATE_ROWS = ", ".join(f"({i}, '{label}', {share}, {base}, '{text}')" for i, (label, share, base, text) in enumerate(licenses.TEMPLATES))
OP12_SQL = f"""
with l as (
  select * from (values {_TEMPLATE_ROWS}) as v(template, label, share, base, text)
), x as (
  select template, regexp_extract_all(translate(text, '{licenses.UPPER}', '{licenses.LOWER}'), '{licenses.WORD}') as w from l
), tg as (
  select template, unnest(range(len(w) - 2)) as at_place, w from x
), g as (
  select template, at_place, w[at_place + 1] || ' ' || w[at_place + 2] || ' ' || w[at_place + 3] as gram from tg
), sizes as (
  select template, count(*) as size from g group by template
), d as materialized (
  select row_number() over () as id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '{licenses.WORD}') as w
  from documents
), dg as (
  select id, unnest(range(greatest(len(w) - 2, 0))) as place, w from d
), h as (
  select id, template, place - at_place as diagonal, at_place
  from (select id, place, w[place + 1] || ' ' || w[place + 2] || ' ' || w[place + 3] as gram from dg) join g using (gram)
), v as (
  select id, template, diagonal, count(*) as n, min(at_place) as low, max(at_place) as high from h group by all
), r as (
  select *, sum(fresh) over (partition by id, template order by diagonal rows unbounded preceding) as run
  from (
    select *, case when diagonal - lag(diagonal) over (partition by id, template order by diagonal) > {licenses.DRIFT} then 1 else 0 end as fresh
    from v
  )
), c as (
  select id, template, run, count(distinct at_place) as covered from h join r using (id, template, diagonal) group by all
), s as (
  select r.id, r.template, r.run, min(diagonal + low) as first, max(diagonal + high + 2) as last,
    count(*) filter (base and n = size) as places,
    min(diagonal) filter (base and n = size) as first_place, max(diagonal) filter (base and n = size) as last_place
  from r join l using (template) join sizes using (template) group by all
), f as (
  select s.*, label, covered::double / size::double as part,
    case when base then places > 0 else covered::double / size::double >= share and last - first + 1 <= {licenses.STRETCH} * (size + 2) end as verified
  from s join c using (id, template, run) join l using (template) join sizes using (template)
), a as (
  select id, sum(places)::bigint as n_base, min(first_place)::bigint as first_word, max(last_place)::bigint as last_word,
    array_to_string(list_sort(list(distinct label) filter (places > 0)), ',') as base_labels,
    array_to_string(list_sort(list(distinct label) filter (verified)), ',') as labels, max(part) as score
  from f group by id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0)::double as score
from d left join a using (id)
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of all documents, in every order, by language."""
    return filter_audit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


OP13_SQL = """
with t as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), l as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
  from labels where doc_id is not null group by doc_id
), m as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    (case when len(w) < 200 then 1 else 0 end) + (case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end)
    + (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 4 else 0 end)
    + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end)
    + (case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end) as failed
  from t left join l using (doc_id)
), g as (
  select part, good, toxic, failed, count(*) as n from m group by all
), f as (
  select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as v(name, bit)
), o as (
  select a.name || b.name || c.name || d.name || e.name as filter_order
  from f a, f b, f c, f d, f e where a.bit + b.bit + c.bit + d.bit + e.bit = 31
    and length(replace(replace(replace(replace(replace(a.name || b.name || c.name || d.name || e.name, 'A', ''), 'B', ''), 'C', ''), 'D', ''), 'E', '')) = 0
    and len(list_distinct([a.name, b.name, c.name, d.name, e.name])) = 5
), s as (
  select filter_order, step, bit, (sum(bit) over (partition by filter_order order by step) - bit)::int as before
  from (select filter_order, unnest([1, 2, 3, 4, 5]) as step from o) join f on f.name = substr(filter_order, step, 1)
), r as (
  select part, filter_order, step::int as step, bit,
    coalesce(sum(n) filter (failed & (before | bit) = 0), 0)::bigint as kept,
    coalesce(sum(n) filter (failed & before = 0 and failed & bit <> 0), 0)::bigint as removed,
    coalesce(sum(n) filter (failed & before <> 0 and failed & bit <> 0), 0)::bigint as redundant,
    coalesce(sum(n) filter (failed = bit), 0)::bigint as unique_fails,
    coalesce(sum(n) filter (failed & before = 0 and failed & bit <> 0 and good), 0)::bigint as good_lost,
    coalesce(sum(n) filter (failed & before = 0 and failed & bit <> 0 and toxic), 0)::bigint as toxic_lost
  from g, s group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, bit))::bigint as shapley
from r
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_mixing": op2_mixing,
    "op3_bpe": op3_bpe,
    "op4_toxicity": op4_toxicity,
    "op5_substrings": op5_substrings,
    "op6_pages": op6_pages,
    "op7_repeats": op7_repeats,
    "op8_quality": op8_quality,
    "op9_merkle": op9_merkle,
    "op10_jaccard": op10_jaccard,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_licenses": op12_licenses,
    "op13_filter_audit": op13_filter_audit,
}

SQL: dict[str, str] = {
    "op2_mixing": OP2_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_licenses": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
