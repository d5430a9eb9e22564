"""The registered queries of the training-data operators and their DuckDB oracles.

Each query applies its operator to its whole table and returns every row.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import bpe
from .conversations import damaged, repair_conversations
from .licences import scan_licences
from .linededup import line_dedup
from .mixing import mix_sources
from .neardup import near_duplicates
from .negatives import hard_negatives
from .neighbours import nearest_neighbours
from .ngramjoin import ngram_join
from .quality import quality_rules
from .substrings import remove_repeats
from .toxicity import toxicity
from .urlfilter import Rule, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), size=4, percent=80)


QUERIES["op1_near_duplicates"] = op1_near_duplicates


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(_read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(_read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


QUERIES["op6_line_dedup"] = op6_line_dedup
QUERIES["op9_byte_bpe"] = op9_byte_bpe


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_read(spark, sf_dir, "documents"), size=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_read(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_read(spark, sf_dir, "documents"))


URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(_read(spark, sf_dir, "pages"), URL_RULES)


QUERIES["op3_repeated_passages"] = op3_repeated_passages
QUERIES["op4_mixing"] = op4_mixing
QUERIES["op5_quality_rules"] = op5_quality_rules
QUERIES["op10_url_filter"] = op10_url_filter

_SPACE = r"[\x20\x09-\x0D]"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op1_near_duplicates"] = f"""
with recursive w as (
  select doc_id, list_filter(string_split_regex({_FOLD.format("coalesce(text, '')")}, '{_SPACE}+'), lambda x: x <> '') as w from documents),
s as (
  select doc_id, array_to_string(w[i:i + 3], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from w where len(w) > 0)
  group by all),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as both_have from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
e as (
  select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * both_have >= 80 * (x.n + y.n - both_have)),
r as (select doc_id as node, doc_id as root from w union select e.b, r.root from r join e on e.a = r.node)
select r.node as doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(r.root) as component_id, r.node = min(r.root) as kept
from r left join n on n.doc_id = r.node group by r.node
"""

ORACLES["op3_repeated_passages"] = f"""
with d as (select doc_id, {_WORDS} as w from documents),
k as (select doc_id, i, array_to_string(w[i:i + 49], ' ') as t from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d)),
f as (select doc_id, i, min(doc_id) over (partition by t) as least from k),
c as (select distinct doc_id, unnest(range(i, i + 50)) as i from f where least < doc_id),
x as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from d),
j as (select x.*, c.i is not null as gone from x left join c using (doc_id, i))
select d.doc_id, len(any_value(d.w))::bigint as n_words, count(*) filter (j.gone) as n_removed,
  sha256(coalesce(string_agg(j.word, ' ' order by j.i) filter (not j.gone), '')) as kept_sha256
from d left join j using (doc_id) group by d.doc_id
"""

ORACLES["op5_quality_rules"] = f"""
with d as (select doc_id, source, coalesce(text, '') as text, {_WORDS} as w from documents),
g as (select doc_id, i, hash(w[i], w[i + 1], w[i + 2]) as h, w[i:i + 2] as t from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)),
c as (select doc_id, i from g qualify count(*) over (partition by doc_id, h, t) > 1),
r as (select doc_id, count(distinct i + k) as n from c, (select unnest([0, 1, 2]) as k) group by doc_id),
m as (
  select d.doc_id, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l,
    coalesce(r.n, 0)::bigint as n_repeat_words
  from d left join r using (doc_id)),
b as (
  select * exclude (l), (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
h as (select source, count(*) as n, sum(base_failed::int) as f from b group by source),
q as (select avg(f / n) as mean, var_pop(f / n) as spread from h),
v as (
  select source, case when spread = 0 then mean
    else (f + mean * greatest(mean * (1 - mean) / spread - 1, 1e-6)) / (n + greatest(mean * (1 - mean) / spread - 1, 1e-6)) end as rate
  from h, q)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and rate <= 0.8 as kept
from b join v on b.source is not distinct from v.source
"""

ORACLES["op6_line_dedup"] = f"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents),
k as (select *, {_FOLD.format("regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')")} as key from l),
f as (select key, max(doc_id) as last from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
j as (select k.*, last is not null and last <> doc_id as gone from k left join f using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from j group by doc_id
"""

ORACLES["op10_url_filter"] = f"""
with u as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (
  select page_id, {_FOLD.format("regexp_extract(rest, '^[^/?#]*')")} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
r (rule_host, rule_path, rule_verdict) as (values {', '.join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)}),
m as (
  select page_id, rule_host || rule_path as rule, rule_verdict from p join r
    on ('.' || host) like ('%.' || rule_host) and starts_with(path, rule_path)
  qualify row_number() over (partition by page_id order by length(rule_host || rule_path) desc) = 1)
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict from p left join m using (page_id)
"""


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings")
    return nearest_neighbours(rows, rows.where("vec_id % 20 = 0"), k=20)


QUERIES["op7_nearest_neighbours"] = op7_nearest_neighbours


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


QUERIES["op2_toxicity"] = op2_toxicity


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_licences(_read(spark, sf_dir, "documents"))
    return scanned.select(
        "doc_id",
        "n_paragraphs",
        F.size("found").cast("long").alias("n_found"),
        F.array_join("families", ",").alias("families"),
        F.round(F.array_max(F.transform("found", lambda x: x.probability)), 6).alias("best_probability"),
    )


QUERIES["op8_licences"] = op8_licences


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(_read(spark, sf_dir, "conversations")), copies="copies")


QUERIES["op13_conversation_repair"] = op13_conversation_repair


def _repair_sql() -> str:
    """The repair as a recursive query over the turns: a struct (cost, audit, lines) per state."""
    follows = {"x": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    into: dict[str, list[str]] = {q: [] for q in follows}

    def edge(src: str, dst: str, cost: str, letters: str, lines: list[str], when: str) -> None:
        added = f"list_concat({src}.o, [{', '.join(lines)}])" if lines else f"{src}.o"
        into[dst].append(f"case when {src} is not null and {when} then {{'c': {src}.c + {cost}, 'a': {src}.a || '{letters}', 'o': {added}}} end")

    for q, then in follows.items():
        edge(q, q, "3", "D", [], "true")
        blank = f"'{names[then]}:'"
        for at, letters, cost, lines in ((q, "", "0", []), (then, "I", "2", [blank])):
            keeps = {follows[at]} | ({"s"} if at == "x" else set())
            for k in keeps:
                edge(q, k, f"{cost} + cut::int", letters + "K", [*lines, "role || ':' || text"], f"not forced and ini = '{k}'")
            to = follows[at]
            edge(q, to, f"{cost} + 2 + cut::int", letters + "R", [*lines, f"'{names[to]}:' || text"], "not forced")
    least = {q: f"list_sort(list_filter([{', '.join(c)}], lambda z: z is not null))[1]" for q, c in into.items()}
    return f"""
with recursive tab as (
  select list(list_reduce(list_prepend(n, range(8)), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by n) as t
  from range(256) as r(n)),
h as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::bigint, list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ascii(x)::bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 as kind
  from conversations, tab),
e as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text,
    unnest(range(case when kind = 0 then 0 when kind = 3 then 2 else 1 end)) as copy from h),
f as (
  select *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare, left(role, 1) as ini,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again,
    row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
    lag(left(role, 1)) over (partition by conv_id order by turn nulls first, role, text, copy) as pre from e),
g as (
  select *, bare = '' as blank, again and bare <> '' as dup, bare <> '' and not again and right(bare, 1) not in ('.', '!', '?') as cut,
    bare = '' or again as forced from f),
c as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (blank) as blank, count(*) filter (dup) as duplicate, count(*) filter (cut) as truncated,
    count(*) filter (pre is not null and pre || ini not in ('su', 'ua', 'au')) as illegal from g group by conv_id),
p as (
  select conv_id, n, 0::bigint as pos, {{'c': 0::bigint, 'a': '', 'o': []::varchar[]}} as x,
    null::struct(c bigint, a varchar, o varchar[]) as s, null::struct(c bigint, a varchar, o varchar[]) as u, null::struct(c bigint, a varchar, o varchar[]) as a
  from c
  union all
  select p.conv_id, n, pos + 1, {least['x']}, {least['s']}, {least['u']}, {least['a']}
  from p join g on g.conv_id is not distinct from p.conv_id and g.i = p.pos + 1),
q as (
  select conv_id, list_sort(list_filter([x, a,
    case when u is not null then {{'c': u.c + 2, 'a': u.a || 'I', 'o': list_append(u.o, 'assistant:')}} end,
    case when s is not null then {{'c': s.c + 4, 'a': s.a || 'II', 'o': list_concat(s.o, ['user:', 'assistant:'])}} end], lambda z: z is not null))[1] as best
  from p where pos = n)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(best.c, 0)::bigint as cost,
  coalesce(best.a, '') as audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) as repaired_sha256,
  coalesce(len(best.o), 0)::bigint as n_turns
from (select distinct conv_id from conversations) o
left join c on c.conv_id is not distinct from o.conv_id left join q on q.conv_id is not distinct from o.conv_id
"""


ORACLES["op13_conversation_repair"] = _repair_sql()


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, rows.where("vec_id % 100 = 0"))


QUERIES["op12_hard_negatives"] = op12_hard_negatives

ORACLES["op12_hard_negatives"] = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (
  select a.vec_id as a, b.vec_id as b, a.label = b.label as alike,
    list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::bigint as s
  from e a join e b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
g as (select * from p where alike qualify row_number() over (partition by a order by s desc, b) <= 5),
n as (
  select g.a as anchor_id, g.b as positive_id,
    row_number() over (partition by g.a, g.b order by p.s desc, p.b) as rank,
    p.b as negative_id, g.s as positive_score, p.s as negative_score
  from g join p on p.a = g.a and not p.alike and 80 * g.s <= 100 * p.s and 100 * p.s <= 100 * g.s)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from n where rank <= 5
"""


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_read(spark, sf_dir, "documents"), size=4, percent=85)


QUERIES["op11_ngram_join"] = op11_ngram_join

ORACLES["op11_ngram_join"] = ORACLES["op1_near_duplicates"].replace("100 * both_have >= 80", "100 * both_have >= 85").replace(
    " as component_id, r.node = min(r.root) as kept", " as component_id"
)
