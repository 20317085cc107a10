"""The registered queries of this package and their SQL, where SQL can say it."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from basketlens.llm import byte_bpe, exact_dedup, html_text, lexical, licenses, neighbours, packing, quality, shingle_join, simhash, spelling, substring_dedup, wordpiece
from basketlens.llm.common import table


def op1_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark, sf_dir):
    return substring_dedup.substring_report(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip_report(table(spark, sf_dir, "documents"),
                                      public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_quality(spark, sf_dir):
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_licenses(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup_report(table(spark, sf_dir, "documents"))


def op8_token_counts(spark, sf_dir):
    return wordpiece.token_counts(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op9_shingle_join(spark, sf_dir):
    return shingle_join.similar_components(table(spark, sf_dir, "documents"), percent=90, width=3)


def op10_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op11_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_quality": op4_quality,
    "op5_licenses": op5_licenses,
    "op6_html_text": op6_html_text,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_shingle_join": op9_shingle_join,
    "op10_neighbours": op10_neighbours,
    "op11_simhash": op11_simhash,
    "op12_lexical_search": op12_lexical_search,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL = {
    "op2_substring_dedup": r"""
        with words as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        starts as (select doc_id, unnest(range(1, len(w) - 33)) as i from words where len(w) >= 35),
        windows as (select s.doc_id, s.i, array_to_string(w.w[s.i:s.i + 34], ' ') as text
                    from starts s join words w using (doc_id)),
        repeated as (select text from windows group by text having count(*) > 1),
        covered as (select distinct doc_id, unnest(range(i, i + 35)) as i from windows join repeated using (text)),
        places as (select doc_id, unnest(range(1, len(w) + 1)) as i from words),
        kept as (select p.doc_id, count(*) as n, array_to_string(list(w.w[p.i] order by p.i), ' ') as text
                 from places p join words w using (doc_id) left join covered c on c.doc_id = p.doc_id and c.i = p.i
                 where c.i is null group by p.doc_id)
        select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256
        from words left join kept using (doc_id)""",
    "op7_exact_dedup": r"""
        with texts as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
            from documents)
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256(t) as text_sha256
        from texts window same as (partition by t)""",
    "op9_shingle_join": r"""
        with recursive words as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') as w
            from documents),
        starts as (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from words where len(w) > 0),
        shingles as (select distinct doc_id, array_to_string(w[i:i + 2], ' ') as s from starts),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        common as (select a.doc_id as a, b.doc_id as b, count(*) as c
                   from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
        links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
                  where 100 * c >= 90 * (x.n + y.n - c)),
        reached as (select doc_id, doc_id as other from words
                    union select r.doc_id, l.b from reached r join links l on l.a = r.other)
        select doc_id, coalesce(max(n), 0) as n_shingles, min(other) as component_id,
               (select count(*) from links where a = reached.doc_id) as n_links
        from reached left join sizes using (doc_id) group by doc_id""",
    "op12_lexical_search": r"""
        with cut as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
            from documents),
        corpus as (select count(*) filter (len(w) > 0) as docs, sum(len(w))::bigint as terms from cut),
        postings as (select doc_id, n, term, count(*) as tf
                     from (select doc_id, len(w) as n, unnest(w) as term from cut) group by all),
        rarity as (select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as weight
                   from postings, corpus group by term),
        wanted as (select item_id, unnest(regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
                   from benchmark),
        often as (select item_id, term, count(*) as times from wanted group by all),
        scored as (
            select item_id, doc_id, sum(times * weight * ((1000000000 * tf)
                       // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))))::bigint as score
            from often join postings using (term) join rarity using (term), corpus
            group by item_id, doc_id),
        ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank,
                          doc_id, score
                   from scored where score > 0)
        select * from ranked where rank <= 20""",
}
