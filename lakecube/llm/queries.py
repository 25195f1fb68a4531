"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocations, decontaminate, jaccard_join, line_dedup, lm_scoring, packing, prefix_trie, quality_rules, secret_scan, suffix_dedup, toxicity,
               url_filter, warc)
from .base import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


OP10_SQL = r"""
with d as (
  select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), l as (
  select rid, doc_id, i, lines[i] as line,
         translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select rid, doc_id, lines, unnest(range(1, len(lines) + 1)) as i from d)
), k as (
  select key, max(doc_id) as top_doc from l where length(key) >= 20
  group by key having count(distinct doc_id) >= 3
), m as (
  select l.*, (k.key is not null and l.doc_id < k.top_doc) as gone from l left join k using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from m group by rid, doc_id
"""


@query("op10_line_dedup", OP10_SQL)
def op10(spark, sf_dir):
    """Documents with lines repeated in three or more documents dropped, but in the largest doc_id."""
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"))


@query("op7_quality_rules")
def op7(spark, sf_dir):
    """Text counts, the base test and the verdict of the learned decision list for every document."""
    out, _ = quality_rules.judge_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP2_SQL = r"""
with recursive w as (
  select doc_id, string_split_regex(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+') as ws
  from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents)
), s0 as (
  select doc_id, case when len(ws) = 1 and ws[1] = '' then []
                      when len(ws) < 5 then [array_to_string(ws, ' ')]
                      else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) end as sh from w
), n as (
  select doc_id, len(sh) as n from s0
), s as (
  select doc_id, unnest(sh) as g from s0
), cls as (
  select doc_id, n, sig, min(doc_id) over (partition by sig) as rep
  from (select doc_id, len(sh) as n, md5(array_to_string(list_sort(sh), chr(1))) as sig from s0 where len(sh) > 0)
), r as (
  select s.doc_id, s.g, cls.n from s join cls on s.doc_id = cls.doc_id and cls.rep = cls.doc_id
), links as (
  select a.doc_id as x, b.doc_id as y from r a join r b on a.g = b.g and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id having 100 * count(*) >= 75 * (max(a.n) + max(b.n) - count(*))
), e as materialized (
  select x, y from links union select y, x from links
), walk(node, reach) as (
  select rep, rep from (select distinct rep from cls)
  union
  select e.y, walk.reach from walk join e on e.x = walk.node
), comp as (
  select node, min(reach) as component_id from walk group by node
)
select n.doc_id, n.n as n_shingles, coalesce(comp.component_id, n.doc_id) as component_id
from n left join cls on cls.doc_id = n.doc_id left join comp on comp.node = cls.rep
"""


@query("op2_jaccard_join", OP2_SQL)
def op2(spark, sf_dir):
    """Connected components of documents whose 5-word shingle sets are similar to 0.75 or more."""
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


OP8_SQL = r"""
with t as (
  select 0 as kind, doc_id as id, text from documents where doc_id is not null
  union all
  select 1, item_id, max(text) from benchmark where item_id is not null group by item_id
), w as (
  select kind, id, string_split_regex(trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+') as ws from t
), s0 as (
  select kind, id, case when len(ws) = 1 and ws[1] = '' then []
                        when len(ws) < 5 then [array_to_string(ws, ' ')]
                        else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) end as sh from w
), q as (
  select id as item_id, len(sh) as n_item, unnest(sh) as g from s0 where kind = 1
), d as (
  select id as doc_id, unnest(sh) as g from s0 where kind = 0
)
select doc_id, item_id, n_item, count(*) as n_shared from q join d using (g)
group by doc_id, item_id, n_item having 4 * count(*) >= 3 * n_item
"""


@query("op8_decontaminate", OP8_SQL)
def op8(spark, sf_dir):
    """Pairs of a document and a benchmark item of whose shingles it holds three quarters or more."""
    docs = read_table(spark, sf_dir, "documents")
    return decontaminate.contaminated_pairs(docs, read_table(spark, sf_dir, "benchmark"))


@query("op9_best_fit_packing")
def op9(spark, sf_dir):
    """All documents' token pieces, packed into sequences of 1024 by the sum-of-squares rule."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5(spark, sf_dir):
    """A toxicity score for every document, learned from the labelled rows that are not held out."""
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


OP4_SQL = r"""
with p as (
  select page_id, encode(coalesce(html, '')) as body from pages
), d as (
  select page_id, octet_length(body) as n, sha256(body) as h from p
), f as (
  select h, min(page_id) as first_id from d where n >= 100 group by h
)
select d.page_id, d.n as payload_bytes, d.h as payload_digest,
       case when d.page_id > f.first_id then 'revisit' else 'response' end as record_type,
       case when d.page_id > f.first_id then f.first_id end as refers_to
from d left join f on d.h = f.h and d.n >= 100
"""


@query("op4_warc", OP4_SQL)
def op4(spark, sf_dir):
    """All pages written as a sharded WARC archive and read back from it."""
    pages = read_table(spark, sf_dir, "pages")
    folder, _ = warc.write_archive(pages)
    out = warc.read_archive(spark, folder)
    kind = pages.schema["page_id"].dataType
    return out.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast(kind).alias("refers_to"))


@query("op6_url_filters")
def op6(spark, sf_dir):
    """Every page's host, path and rule, and a verdict from the rule or the character models."""
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


@query("op3_lm_scoring")
def op3(spark, sf_dir):
    """Every document's masked pseudo-log-likelihood under a network trained on all documents."""
    return lm_scoring.score_documents(read_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as hx from documents
), b as (
  select doc_id, hx, length(hx) // 2 as n from d
), p as (
  select doc_id, n, k, substr(hx, 512 * k + 1, 710) as piece from (select doc_id, hx, n, unnest(range(0, (n - 99 + 255) // 256)) as k from b where n >= 100)
), w as (
  select doc_id, 256 * k + j as i, md5_number(substr(piece, 2 * j + 1, 200)) as s
  from (select doc_id, k, piece, unnest(range(0, least(256, n - 99 - 256 * k))) as j from p)
), f as (
  select s, min({'d': doc_id, 'i': i}) as first_at from w group by s having count(*) > 1
), g as (
  select w.doc_id, w.i from w join f using (s) where f.first_at <> {'d': w.doc_id, 'i': w.i}
), r as (
  select doc_id, i, sum(case when prev is null or i > prev + 100 then 1 else 0 end) over (partition by doc_id order by i) as run
  from (select doc_id, i, lag(i) over (partition by doc_id order by i) as prev from g)
), spans as (
  select doc_id, run, min(i) as a, max(i) + 100 as z from r group by doc_id, run
), cuts as (
  select doc_id, list(a order by a) as starts, list(z order by a) as ends, sum(z - a) as n_removed, count(*) as n_spans from spans group by doc_id
)
select b.doc_id, b.n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(case when starts is null then hx else array_to_string(list_transform(range(0, len(starts) + 1),
         lambda k: substr(hx, 2 * (case when k = 0 then 0 else ends[k] end) + 1,
                          2 * ((case when k = len(starts) then b.n else starts[k + 1] end) - (case when k = 0 then 0 else ends[k] end)))), '') end)) as kept_sha256
from b left join cuts using (doc_id)
"""


@query("op1_suffix_dedup", OP1_SQL)
def op1(spark, sf_dir):
    """Documents without the bytes of 100-byte strings that also start earlier."""
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
                      F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = r"""
with recursive own as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, tag) - 1 as pos, tag, n_words
  from (select conv_id, turn, md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as tag,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n_words from conversations where conv_id is not null)
), size as (
  select c, count(*) as n_own from own group by c
), bits(c, i, crc) as (
  select c, 0, 4294967295::ubigint from size
  union all
  select c, i + 1, case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end
  from (select c, i, case when i % 8 = 0 then xor(crc, ascii(substr(c::varchar, i // 8 + 1, 1))::ubigint) else crc end as x
        from bits where i < 8 * length(c::varchar))
), h as (
  select c, xor(crc, 4294967295::ubigint) % 4 as h from bits where i = 8 * length(c::varchar)
), k as (
  select size.c, size.c - size.c % 20 as base, h.h, least(h.h, coalesce(b.n_own, 0)) as taken
  from size join h using (c) left join size b on b.c = size.c - size.c % 20
), r as (
  select k.c, own.pos, own.tag, own.n_words from k join own on own.c = k.base where own.pos < k.taken
  union all
  select k.c, own.pos - k.h + k.taken, own.tag, own.n_words from k join own on own.c = k.c where own.pos >= k.h
), l as (
  select k.c, coalesce(list(r.tag order by r.pos) filter (r.tag is not null), []) as tags,
         coalesce(list(r.n_words order by r.pos) filter (r.tag is not null), []) as ws
  from k left join r on r.c = k.c group by k.c
), m as (
  select c, d, len(tags) as n, md5(array_to_string(tags[1:d], '')) as key, case when d > 0 then ws[d] else 0 end as n_words,
         case when d > 0 then md5(array_to_string(tags[1:d - 1], '')) end as pkey
  from (select c, tags, ws, unnest(range(0, len(tags) + 1)) as d from l)
), n as (
  select d, key, max(pkey) as pkey, min(c) as conv, count(*) as n_convs, max(n_words) as n_words,
         sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (n = d), '')) as ends_sha256 from m group by d, key
), kids as (
  select d - 1 as d, pkey as key, count(*) as n_children from n where d > 0 group by d - 1, pkey
), v as (
  select n.*, coalesce(kids.n_children, 0) as n_children, case when kids.n_children is null then 1 else 0 end as leaf,
         (n.n_convs - 1) * n.n_words as saved from n left join kids on kids.d = n.d and kids.key = n.key
), s as (
  select m.d, m.key, sum(v.leaf)::bigint as n_leaves, sum(v.saved)::bigint as saved_tokens
  from v join m on m.c = v.conv and m.d <= v.d group by m.d, m.key
)
select v.conv as conv_id, v.d as depth, p.conv as parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
from v join s on s.d = v.d and s.key = v.key left join v p on p.d = v.d - 1 and p.key = v.pkey
"""


@query("op11_prefix_trie", OP11_SQL)
def op11(spark, sf_dir):
    """Every node of the conversations' prefix trie, with its subtree's leaves and saved tokens."""
    out = prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations"))
    return out.drop("enter", "exit")


OP13_SQL = r"""
with p as (
  select lang, row_number() over () as pid, piece from (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) as piece from documents)
), w as (
  select lang, pid, unnest(ws) as w, unnest(range(len(ws))) as i from (select lang, pid, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p)
), g as materialized (
  select lang, w as w1, lead(w, 1) over q as w2, lead(w, 2) over q as w3, lead(w, 3) over q as w4, lead(w, 4) over q as w5
  from w window q as (partition by pid order by i)
), f as materialized (
  select lang, 1 as k, w1 as phrase, count(*) as f from g group by all
  union all
  select lang, 2, w1 || ' ' || w2, count(*) from g where w2 is not null group by all having count(*) >= 100
  union all
  select lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) from g where w3 is not null group by all having count(*) >= 100
  union all
  select lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) from g where w4 is not null group by all having count(*) >= 100
  union all
  select lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5, count(*) from g where w5 is not null group by all having count(*) >= 100
), t as (
  select lang, count(*) as n from g group by lang
), c as materialized (
  select lang, k, phrase, f as a, string_split(phrase, ' ') as ws from f where k > 1
), x as materialized (
  select lang || chr(1) || phrase as key, f from f
), cut as (
  select lang, phrase, k, a, j, lang || chr(1) || array_to_string(ws[1:j], ' ') as head, lang || chr(1) || array_to_string(ws[j + 1:k], ' ') as tail
  from (select *, unnest(range(1, k)) as j from c)
), s as (
  select cut.*, h.f as l, q.f as r, t.n, (1000::hugeint * cut.a * t.n) // (h.f::hugeint * q.f) as score
  from cut join x h on h.key = cut.head join x q on q.key = cut.tail join t on t.lang = cut.lang
), b as (
  select * from (select *, row_number() over (partition by lang, phrase order by score, j) as o from s) where o = 1
), d as (
  select distinct lang, sub, a from (
    select lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) as sub from c, range(2, 5) v(m) where m < k)
), z as (
  select lang, phrase, a, l, r, n, score::bigint as score from b
  where not exists (select 1 from d where d.lang = b.lang and d.sub = b.phrase and 100 * d.a >= 100 * b.a)
)
select * from (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from z) where rank <= 2000
"""


@query("op13_collocations", OP13_SQL)
def op13(spark, sf_dir):
    """Each language's 2000 phrases of two to five words that hold together most."""
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


@query("op12_secret_scan")
def op12(spark, sf_dir):
    """Every document's secrets: the fixed patterns' finds and the random field's further spans."""
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))
