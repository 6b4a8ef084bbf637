"""The queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroid_clusters import cluster
from .embedding_dedup import near_vectors
from .fingerprints import fingerprint_edits
from .html_consensus import extract
from .importance_resampling import resample
from .kmeans_tree_search import search
from .language_id import fold, identify
from .minhash_dedup import near_duplicates
from .mixing import mix
from .quality import score_quality
from .sentence_pieces import round_trip as piece_round_trip
from .suffix_dedup import repeat_digests
from .token_files import round_trip


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file `name` lies on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_naive_bayes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn(
        "held_out", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)))
    train = docs.filter(fold("doc_id", 4) != 2)
    return identify(docs, train, ["doc_id", "held_out"])


def op2_one_permutation_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(_table(spark, sf_dir, "documents"))


def op3_consensus_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"), ["page_id", "url"])


def op4_positive_unlabelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"))
    taught = (_table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0).filter("quality is not null")
              .select("doc_id", "quality"))
    scored = score_quality(docs, taught.filter("quality = 1"), taught, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_viterbi_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"), max_repeats=4.0)


def op7_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, threshold=80)


def op8_induced_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(_table(spark, sf_dir, "documents"))


def op9_huffman_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_subspace_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), 0.93)


def op11_arrow_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_threshold_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(_table(spark, sf_dir, "embeddings"))


def op13_kmeans_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_naive_bayes_language": op1_naive_bayes_language,
    "op2_one_permutation_minhash": op2_one_permutation_minhash,
    "op3_consensus_html_text": op3_consensus_html_text,
    "op4_positive_unlabelled_quality": op4_positive_unlabelled_quality,
    "op5_viterbi_sentence_pieces": op5_viterbi_sentence_pieces,
    "op6_temperature_mixing": op6_temperature_mixing,
    "op7_hyperminhash_dedup": op7_hyperminhash_dedup,
    "op8_induced_suffix_dedup": op8_induced_suffix_dedup,
    "op9_huffman_token_files": op9_huffman_token_files,
    "op10_subspace_embedding_dedup": op10_subspace_embedding_dedup,
    "op11_arrow_importance_resampling": op11_arrow_importance_resampling,
    "op12_threshold_centroid_clusters": op12_threshold_centroid_clusters,
    "op13_kmeans_tree_neighbours": op13_kmeans_tree_neighbours,
}


def _cluster_sql(k: int = 8, dims: int = 64, rounds: int = 10) -> str:
    """The clustering of op12, with a table of centroids for each round."""
    apart = "cast(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint)"

    def near(i: int) -> str:
        # The least of distance * k + number is the nearest one of least number.
        return f"select row, vec_id, v, min({apart} * {k} + j) as m from points, c{i} group by row, vec_id, v"

    steps = [f"""c{i + 1} as materialized (
      select j, coalesce(n.c, o.c) as c from c{i} o left join (
        select j, list((t - (t % n + n) % n) // n order by d) as c from (
          select m % {k} as j, d, cast(sum(v[d]) as hugeint) as t, count(*) as n
          from ({near(i)}) a, range(1, {dims + 1}) r(d) group by 1, 2) s group by j) n using (j))"""
             for i in range(rounds)]
    return f"""with points as materialized (
      select row_number() over () as row, vec_id,
        list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
      from embeddings where len(embedding) = {dims}
        and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0),
    c0 as materialized (
      select row_number() over (order by h, v) - 1 as j, v as c
      from (select sha256('3:' || coalesce(cast(vec_id as varchar), '')) as h, v from points) p
      qualify row_number() over (order by h, v) <= {k}),
    {", ".join(steps)},
    last as (select vec_id, m % {k} as j, m // {k} as distance from ({near(rounds)}) a)
    select vec_id, cast(j as int) as cluster, cast(distance as bigint) as distance,
      cast(sum(distance) over (partition by j) as bigint) as cluster_inertia,
      cast(sum(distance) over () as bigint) as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
    from last join c{rounds} using (j)"""


_REACH = """reach as (
      select id, id as other from nodes
      union select r.id, l.b from reach r join links l on l.a = r.other),
    least as (select id, min(other) as component_id from reach group by id)"""

ORACLE_SQL: dict[str, str] = {
    "op7_hyperminhash_dedup": rf"""with recursive words as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
    sets as (
      select doc_id, case when len(w) = 0 then [] else list_distinct(list_transform(
        range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) end as s from words),
    items as (select doc_id, len(s) as n, unnest(s) as x from sets),
    links as (
      select a.doc_id as a, b.doc_id as b from items a join items b on a.x = b.x and a.doc_id <> b.doc_id
      group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    nodes as (select doc_id as id from documents),
    {_REACH}
    select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept
    from sets join least on doc_id = id""",
    "op10_subspace_embedding_dedup": f"""with recursive usable as (
      select vec_id, label, cast(embedding as double[]) as x from embeddings
      where label is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
        and len(list_filter(embedding, lambda v: v <> 0)) > 0),
    links as (
      select a.vec_id as a, b.vec_id as b from usable a join usable b
        on a.label = b.label and a.vec_id <> b.vec_id and list_cosine_similarity(a.x, b.x) >= 0.93),
    nodes as (select vec_id as id from embeddings),
    {_REACH}
    select v.vec_id, (select count(*) from links l where l.a = v.vec_id) as n_links, component_id,
      v.vec_id = component_id as kept
    from embeddings v join least on v.vec_id = id""",
    "op11_arrow_importance_resampling": r"""with recursive crc_steps as (
      select i, i as c, 0 as step from range(256) r(i)
      union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, step + 1
      from crc_steps where step < 8),
    crc_table as (select list(c order by i) as t from crc_steps where step = 8),
    doc_words as (
      select doc_id, row_number() over () as row, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
      from documents),
    target_words as (
      select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as x from benchmark),
    words as (select row, unnest(w) as x from doc_words),
    hashed as (
      select x, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(h) // 2),
        lambda i: cast('0x' || substr(h, 2 * i + 1, 2) as bigint))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
      from (select x, hex(encode(x)) as h from (select x from words union select x from target_words) d) b, crc_table),
    source as (select bucket, count(*) as n from words join hashed using (x) group by bucket),
    target as (select bucket, count(*) as n from target_words join hashed using (x) group by bucket),
    gains as (
      select b.bucket, cast(floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (coalesce((select sum(n) from source), 0) + 10000)
        / ((coalesce(s.n, 0) + 1)::double * (coalesce((select sum(n) from target), 0) + 10000)))) as bigint) as gain
      from (select distinct bucket from hashed) b left join source s using (bucket) left join target t using (bucket)),
    weights as (
      select row, cast(sum(gain) as bigint) as weight from words join hashed using (x) join gains using (bucket) group by row),
    scored as (
      select doc_id, len(w) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
        (cast('0x' || substr(sha256('2024:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) + 0.5::double)
        / 4294967296))) as bigint) as score
      from doc_words left join weights using (row)),
    ranked as (
      select doc_id, n_features, weight, score, row_number() over (order by score desc, doc_id nulls last) as rank,
        count(*) over () as n from scored where n_features >= 20)
    select doc_id, n_features, weight, score, case when rank <= 10 * n // 100 then rank end as rank from ranked
    union all select doc_id, n_features, weight, score, null from scored where n_features < 20""",
    "op12_threshold_centroid_clusters": _cluster_sql(),
}
