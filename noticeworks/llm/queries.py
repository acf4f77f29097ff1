"""Queries of the operators over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm import collocations, decontaminate, exact_dedup, katz, language, line_dedup, ngram_join, ordinal, periodic_runs, pieces, preference, ring_sharding, token_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_exact_dedup", f"""
with d as (select doc_id, translate(coalesce(text, ''), {A_Z}) as norm from documents),
g as (select norm, max(doc_id) as keep_id, count(*) as group_size from d group by norm)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.norm) as text_sha256
from d join g using (norm)""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query("op2_line_dedup", """
with l as (
  select doc_id, source, text, unnest(string_split(text, chr(10))) as line,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents),
t as (select *, trim(line, ' ' || chr(9) || chr(13)) as key from l),
spread as (select key, min(doc_id) as keeper from t where key <> '' group by key having count(distinct source) >= 10),
marked as (
  select t.*, s.key is null or (t.doc_id = s.keeper and row_number() over (partition by t.doc_id, t.key order by t.i) = 1) as stays
  from t left join spread s using (key))
select doc_id, count(*) as n_lines, count(*) filter (not stays) as n_removed,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (stays), '')) as text_sha256
from marked group by doc_id""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_dedup(_table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


@_query("op3_ring_sharding")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return ring_sharding.bounded_ring_shards(_table(spark, folder, "documents"))


@_query("op4_ngram_join", f"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {A_Z}), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words
  from documents),
s as (
  select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) end) as gram from w),
n as (select doc_id, count(*) as n from s group by doc_id),
links as (
  select a.doc_id as a, b.doc_id as b from s a join s b on a.gram = b.gram and a.doc_id <> b.doc_id
  join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id having 100 * count(*) >= 90 * (any_value(x.n) + any_value(y.n) - count(*))),
reach as (
  select doc_id as a, doc_id as b from documents
  union select r.a, l.b from reach r join links l on l.a = r.b)
select d.doc_id, coalesce(n.n, 0) as n_shingles, min(r.b) as component_id
from documents d left join n using (doc_id) join reach r on r.a = d.doc_id group by all""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_components(_table(spark, folder, "documents"))


#: A public BPE piece model; another one is given by the path to its file.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@_query("op5_pieces")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode(docs, pieces.Vocabulary.load(PIECE_MODEL), check=True).drop("text")


#: The vocabulary whose tokens are counted, and the number of tokens that fit a context.
COUNTED_VOCABULARY, TOKEN_LIMIT = "word_bpe_49k.json", 2048


@_query("op6_preference", """
with t as (select conv_id as pair_id, turn, role, text from conversations),
m as (select *, max(turn) over (partition by pair_id) as last_turn from t),
e as (select xor(pair_id, 1) as pair_id, role, text from m where turn = last_turn),
sides as (
  select pair_id, 'chosen' as side, turn, role, text from t
  union all select pair_id, 'rejected', turn, role, text from m where turn < last_turn
  union all select e.pair_id, 'rejected', x.last_turn, e.role, e.text
  from e join (select distinct pair_id, last_turn from m) x using (pair_id)),
b as (
  select pair_id, turn, list(role || chr(0) || text order by role, text) filter (side = 'chosen')
         is not distinct from list(role || chr(0) || text order by role, text) filter (side = 'rejected') as same
  from sides group by pair_id, turn),
f as (select pair_id, min(turn) filter (not same) as at from b group by pair_id),
p as (
  select s.*, case when f.at is null or s.turn < f.at then 'prompt' else s.side end as part
  from sides s join f using (pair_id)),
r as (
  select pair_id, part, turn, role, '<|' || role || '|>' || chr(10) as head, text, part <> 'prompt' and role = 'assistant' as trained
  from p where part <> 'prompt' or side = 'chosen')
select pair_id, part, turn, role, head || text || '<|end|>' || chr(10) as rendered,
       case when trained then length(head) else 0 end as mask_start,
       case when trained then length(head) + length(text) + 7 else 0 end as mask_end
from r""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return preference.preference_segments(preference.swapped_endings(_table(spark, folder, "conversations")))


@_query("op7_katz")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return katz.katz_scores(_table(spark, folder, "documents"))


@_query("op8_ordinal_toxicity")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return ordinal.ordinal_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query("op9_decontamination")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query("op10_language_id")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return language.identify(docs, language.fit_text_model(docs), declared=F.col("lang"), host=F.col("source")).select(
        F.col("id").alias("doc_id"), "declared", "language", "confidence", "by_text", "accepted")


def with_planted_period(docs: DataFrame) -> DataFrame:
    """Texts of one row in ten repeat some of their words up to the end.

    With h = crc32 of the id and g = floor(h / 10) these are rows with h % 10 = 0; from word
    a = g % n on, word i becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)).
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    planted = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g")).select(
        "*", F.size("w").alias("n"), (F.col("g") % F.size("w")).cast("int").alias("a")).select(
        "*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int").alias("p"))
    period = F.slice("w", F.col("a") + 1, F.least("p", F.col("n") - F.col("a")))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, times)), 1, F.col("n") - F.col("a"))
    text = F.array_join(F.concat(F.slice("w", 1, F.col("a")), tail), " ")
    return planted.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


@_query("op11_periodic_runs", """
with c as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
         xor(4294967295, list_reduce(
           flatten(list_transform(string_split(doc_id::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda crc, x: case when x >= 0 then xor(crc, x) when crc % 2 = 1 then xor(crc // 2, 3988292384) else crc // 2 end,
           4294967295::bigint)) as h
  from documents),
n as (select doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as planted, h // 10 as g, (h // 10) % greatest(len(w), 1) as a from c),
p as (select *, 1 + (n - a) // (3 + g % 8) as p from n),
d as (
  select doc_id, n, case when planted then list_transform(range(0, n), lambda i: case when i < a then w[i + 1] else w[a + (i - a) % p + 1] end)
                    else w end as words from p),
g as (
  select doc_id, unnest(range(0, n - 5)) as i, unnest(list_transform(range(0, n - 5), lambda i: array_to_string(words[i + 1:i + 6], ' '))) as gram
  from d),
m as (select x.doc_id, x.i, y.i - x.i as period from g x join g y on x.doc_id = y.doc_id and x.gram = y.gram and x.i < y.i),
s as (select *, i - row_number() over (partition by doc_id, period order by i) as island from m),
stretches as (select doc_id, min(i) as start, count(*) + 5 + period as length, period from s group by doc_id, period, island),
runs as (
  select doc_id, start, length, min(period) as period from stretches where length >= greatest(12, 2 * period) group by doc_id, start, length),
r as (
  select doc_id, count(*) as n_runs, list([start, length, period] order by length desc, start, period)[1] as best,
         list([start + period, start + length]) as repeats,
         string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as listed
  from runs group by doc_id)
select d.doc_id, coalesce(n_runs, 0) as n_runs, best[1] as start, best[2] as length, best[3] as period,
       1000 * best[2] // best[3] as exponent_milli, sha256(coalesce(listed, '')) as runs_sha256,
       sha256(array_to_string(case when n_runs is null then words else list_filter(words, lambda x, i:
         len(list_filter(repeats, lambda q: i - 1 >= q[1] and i - 1 < q[2])) = 0) end, ' ')) as collapsed_sha256
from d left join r using (doc_id)""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_period(_table(spark, folder, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-best["start"]).alias("start"), best["length"].alias("length"),
        (-best["period"]).alias("period"), F.floor(1000 * best["length"] / -best["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@_query("op12_collocations", f"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), {A_Z}), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
w as (select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') as words from p),
g as (select lang, k, words, unnest(range(1, len(words) - k + 2)) as i from w, range(1, 6) as t(k)),
f as (select lang, k, array_to_string(words[i:i + k - 1], ' ') as phrase, count(*) as c from g group by all),
n as (select lang, sum(c)::hugeint as n from f where k = 1 group by lang),
often as (select * from f where k > 1 and c >= 100),
inside as (
  select distinct s.lang, s.phrase from often s join often l
  on s.lang = l.lang and s.k < l.k and 100 * l.c >= 100 * s.c and contains(' ' || l.phrase || ' ', ' ' || s.phrase || ' ')),
cuts as (
  select lang, phrase, c as a, unnest(range(1, k)) as cut, string_split(phrase, ' ') as words
  from often anti join inside using (lang, phrase)),
scored as (
  select x.lang, x.phrase, x.a, x.cut, l.c as l, r.c as r, n.n, (1000 * x.a::hugeint * n.n) // (l.c::hugeint * r.c) as score
  from cuts x join n using (lang)
  join f l on l.lang = x.lang and l.phrase = array_to_string(words[:cut], ' ')
  join f r on r.lang = x.lang and r.phrase = array_to_string(words[cut + 1:], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n::bigint as n, score::bigint as score
from best qualify rank <= 2000""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"), threshold=100, percent=100, top=2000)


@_query("op13_token_counts")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path(COUNTED_VOCABULARY), encoding="utf-8") as file:
        spec = file.read()
    return token_counts.token_counts(_table(spark, folder, "documents"), spec).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
