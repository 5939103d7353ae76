"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontamination import op3_string_tiling
from .harmonic import op11_harmonic
from .language_id import op6_subword_language
from .line_dedup import op4_fuzzy_lines
from .lm_scoring import op9_maximum_entropy
from .merkle import op13_postorder_log
from .minhash import op2_circulant_minhash
from .packing import op8_linear_grouping
from .quality_classifier import op7_additive_quality
from .quality_rules import op1_compression_bands
from .term_scan import op12_term_scan
from .token_files import op5_context_mixing
from .warc import op10_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_compression_bands": op1_compression_bands,
    "op2_circulant_minhash": op2_circulant_minhash,
    "op3_string_tiling": op3_string_tiling,
    "op4_fuzzy_lines": op4_fuzzy_lines,
    "op5_context_mixing": op5_context_mixing,
    "op6_subword_language": op6_subword_language,
    "op7_additive_quality": op7_additive_quality,
    "op8_linear_grouping": op8_linear_grouping,
    "op9_maximum_entropy": op9_maximum_entropy,
    "op10_warc": op10_warc,
    "op11_harmonic": op11_harmonic,
    "op12_term_scan": op12_term_scan,
    "op13_postorder_log": op13_postorder_log,
}

_NEAR_DUPLICATES = """
with recursive w as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') ws
  from documents),
s as (
  select distinct doc_id, unnest(
    case when len(ws) = 0 then []
         when len(ws) < 4 then [array_to_string(ws, ' ')]
         else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) end) sh
  from w),
n as (select doc_id, count(*) n from s group by doc_id),
p as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by 1, 2),
e as (
  select a, b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b
  where 100 * c >= 80 * (x.n + y.n - c)),
r(a, b) as (select a, b from e union select r.a, e.b from r join e on r.b = e.a)
select w.doc_id, coalesce(any_value(n.n), 0)::bigint n_shingles,
  least(w.doc_id, coalesce(min(r.b), w.doc_id)) component_id,
  w.doc_id = least(w.doc_id, coalesce(min(r.b), w.doc_id)) kept
from w left join n using (doc_id) left join r on r.a = w.doc_id group by w.doc_id
"""

_ARCHIVES = """
with p as (
  select page_id, url, octet_length(encode(coalesce(html, ''))) size, sha1(coalesce(html, '')) hex from pages),
g as (select hex, size, max(page_id) keeper from p group by all),
b as (select p.*, g.keeper, cast(unhex(p.hex) as bit)::varchar bits from p join g using (hex, size))
select page_id, size::bigint payload_bytes,
  array_to_string(list_transform(range(0, 160, 5),
    lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + list_sum(list_transform(range(0, 5), lambda j: cast(substr(bits, cast(i + j + 1 as int), 1) as int) * (16 >> j::int)))::int, 1)), '') payload_digest,
  case when page_id = keeper then 'response' else 'revisit' end record_type,
  case when page_id <> keeper then keeper end refers_to, coalesce(url, '') url
from b
"""

_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_SEARCH = f"""
with d as (select doc_id, {_TERMS} ts from documents),
q as (select distinct item_id, unnest({_TERMS}) term from benchmark),
s as (select count(*) all_docs, sum(len(ts))::bigint all_terms from d where len(ts) > 0),
m as (select doc_id, 10 + (90 * len(ts)::bigint * all_docs) // all_terms as m from d, s where len(ts) > 0),
f as (select doc_id, term, count(*) tf from (select doc_id, unnest(ts) term from d) where term in (select term from q) group by all),
w as (select term, floor(1000 * ln((2 * all_docs + 2) / (2 * df + 1)))::bigint w from (select term, count(*) df from f group by term), s),
p as (
  select item_id, doc_id, sum(w * (1000000000 * tf // (1000 * tf + 8 * m)))::bigint score
  from q join f using (term) join w using (term) join m using (doc_id) group by all),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id)::int rank from p where score > 0)
select item_id, rank, doc_id, score from r where rank <= 10
"""

_LEAF = " || ".join(f"coalesce(strlen({x}::varchar) || ':' || {x}, '-')" for x in ("doc_id", "source", "lang", "n_chars", "text"))
_NEXT_LEVEL = "list_transform(range(0, (len(nodes) + 7) // 8), lambda i: sha256(array_to_string(nodes[i * 8 + 1 : i * 8 + 8], '')))"


def _walk(name: str, start: str, nodes: str) -> str:
    """From each start to the top of its tree: the hash folded with its siblings, and the siblings joined."""
    before = "array_to_string(n.nodes[idx // 8 * 8 + 1 : idx], '')"
    after = "array_to_string(n.nodes[idx + 2 : idx // 8 * 8 + 8], '')"
    return f"""{name} as (
  select doc_id, tree, idx, 0 lvl, h, proof from ({start})
  union all
  select doc_id, tree, idx // 8, lvl + 1, sha256({before} || h || {after}), proof || {before} || {after}
  from {name} join {nodes} n using (tree, lvl) where len(n.nodes) > 1)"""


_MANIFEST = f"""
with recursive d as (
  select doc_id, coalesce('=' || lang, '') tree, sha256({_LEAF}) leaf,
    sha256({_LEAF.replace("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) other,
    xor(4294967295, list_reduce(
      flatten([[4294967295], flatten(list_transform(range(1, len(doc_id::varchar) + 1),
        lambda i: [ord(substr(doc_id::varchar, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1]))]),
      lambda a, b: case when b >= 0 then xor(a, b) else xor(a >> 1, 3988292384 * (a & 1)) end)) % 3 = 0 tampered
  from documents),
leaves as (select *, row_number() over (partition by tree order by doc_id, leaf) - 1 idx from d),
levels as (
  select tree, 0 lvl, list(leaf order by idx) nodes from leaves group by tree
  union all select tree, lvl + 1, {_NEXT_LEVEL} from levels where len(nodes) > 1),
subroots as (select tree, nodes[1] subroot, row_number() over (order by tree) - 1 place from levels where len(nodes) = 1),
upper as (
  select '' tree, 0 lvl, list(subroot order by place) nodes from subroots
  union all select tree, lvl + 1, {_NEXT_LEVEL} from upper where len(nodes) > 1),
{_walk("low", "select doc_id, tree, idx, case when tampered then other else leaf end h, '' proof from leaves", "levels")},
{_walk("high", "select doc_id, '' tree, place idx, h, proof from low join subroots using (tree) join levels using (tree, lvl) where len(nodes) = 1", "upper")}
select doc_id, leaf, subroot, nodes[1] root, sha256(proof) proof_sha256, h folded_root, h = nodes[1] verified
from high join upper using (lvl) join leaves using (doc_id) join subroots on subroots.tree = leaves.tree
where len(nodes) = 1
"""

ORACLE: dict[str, str] = {"op2_circulant_minhash": _NEAR_DUPLICATES, "op10_warc": _ARCHIVES, "op12_term_scan": _SEARCH, "op13_postorder_log": _MANIFEST}
