"""Queries of the subpackage, one for each operator, over the whole tables of a scale directory."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm.centroids import cluster_vectors
from helixframe.llm.chat import chat_digests, format_paths, linear_messages, reply_paths
from helixframe.llm.pii import find_pii
from helixframe.llm.decontaminate import contaminated
from helixframe.llm.exact import exact_duplicates
from helixframe.llm.jaccard import similar_documents
from helixframe.llm.katz import score_texts
from helixframe.llm.negatives import mine_negatives
from helixframe.llm.pieces import encode_pieces
from helixframe.llm.quality import quality_rules
from helixframe.llm.repeats import without_repeats
from helixframe.llm.shards import training_order
from helixframe.llm.warc import archive_pages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts are control strings."""
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))],
                                "conv_id long, turn long, role string, text string")
    return chat_digests(format_paths(reply_paths(linear_messages(given.unionByName(own)))))


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order(spark, _table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive_pages(spark, _table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared", "containment")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(_table(spark, sf_dir, "documents"))


def op9_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(_table(spark, sf_dir, "documents"), every_hash=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mine_negatives(_table(spark, sf_dir, "embeddings"))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


QUERIES = {f.__name__: f for f in (op1_jaccard_join, op2_quality_rules, op3_chat_formatting, op4_token_shards, op5_warc, op6_sentencepiece, op7_decontamination, op8_pii,
                                  op9_katz_scores, op10_repeats, op11_centroids, op12_exact_dedup, op13_hard_negatives)}
_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x20\x09-\x0D]+')")


def _sets(name: str, table: str, key: str) -> str:
    """Shingle sets of a table, one row per shingle."""
    return (f"{name} as (select {key}, unnest(list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 4, 1) + 1)])) as s "
            f"from (select {key}, {_WORDS} as w from {table}) where len(w) > 0)")


def _lloyd(rounds: int, k: int, dims: int) -> str:
    """Clusters of integer vectors, one row per component; centroids of each round are a table of their own."""
    steps = [f"""v as (
            select vec_id, generate_subscripts(embedding, 1) as j, cast(floor(64 * cast(unnest(embedding) as double)) as bigint) as x
            from embeddings where len(embedding) = {dims}),
        starts as (select vec_id, row_number() over (order by sha256('1:' || cast(vec_id as varchar))) - 1 as c from (select distinct vec_id from v)),
        c0 as (select c, j, x from starts join v using (vec_id) where c < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""d{r} as (select vec_id, c, sum((v.x - m.x) * (v.x - m.x)) as d from v join c{r} m using (j) group by vec_id, c),
        a{r} as (select vec_id, min(c) as cluster, min(d.d) as distance
                 from d{r} d join (select vec_id, min(d) as least from d{r} group by vec_id) using (vec_id) where d.d = least group by vec_id)""")
        if r < rounds:
            steps.append(f"""n{r} as (select cluster as c, j, cast(floor(sum(x) / cast(count(*) as double)) as bigint) as x
                 from v join a{r} using (vec_id) group by cluster, j),
        c{r + 1} as (select o.c, o.j, coalesce(n.x, o.x) as x from c{r} o left join n{r} n on n.c = o.c and n.j = o.j)""")
    return ",\n        ".join(steps)


#: A SHA-1 in hex as base32: five hex digits hold four letters.
_BASE32 = ("array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
           "((cast(concat('0x', substr(h, (k // 4) * 5 + 1, 5)) as bigint) >> cast(15 - 5 * (k % 4) as bigint)) & 31) + 1, 1)), '')")

ORACLE: dict[str, str] = {
    "op5_warc": f"""
        with p as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h, max(page_id) over (partition by coalesce(html, '')) as last from pages)
        select page_id, cast(strlen(body) as bigint) as payload_bytes, {_BASE32} as payload_digest,
            case when page_id = last then 'response' else 'revisit' end as record_type, case when page_id <> last then last end as refers_to
        from p""",
    "op11_centroids": f"""
        with {_lloyd(3, 16, 64)},
        shas as (select c as cluster, sha256(string_agg(cast(x as varchar), ',' order by j)) as centroid_sha256 from c3 group by c),
        sums as (select cluster, sum(distance) as s from a3 group by cluster)
        select vec_id, cast(cluster as integer) as cluster, cast(distance as bigint) as distance, cast(s as bigint) as cluster_inertia,
            cast((select sum(s) from sums) as bigint) as inertia, centroid_sha256
        from a3 join sums using (cluster) join shas using (cluster)""",
    "op12_exact_dedup": r"""
        with t as (select doc_id, coalesce(text, '') as whole, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as bare from documents),
        g as (select doc_id, bare, first_value(doc_id) over (partition by bare order by length(whole) desc, doc_id) as keep_id,
                count(*) over (partition by bare) as group_size from t)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(bare) as text_sha256 from g""",
    "op13_hard_negatives": """
        with e as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, generate_subscripts(embedding, 1) as j,
                cast(floor(256 * cast(unnest(embedding) as double)) as bigint) as x
            from embeddings where label is not null),
        scores as (
            select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, cast(sum(a.x * b.x) as bigint) as score
            from e a join e b on a.j = b.j and a.vec_id <> b.vec_id where a.vec_id % 100 = 0 group by a.vec_id, b.vec_id, a.label = b.label),
        positives as (
            select anchor_id, other_id as positive_id, score as positive_score from (
                select *, row_number() over (partition by anchor_id order by score desc, other_id) as r from scores where same) where r <= 5),
        negatives as (
            select p.*, n.other_id as negative_id, n.score as negative_score,
                row_number() over (partition by p.anchor_id, positive_id order by n.score desc, n.other_id) as rank
            from positives p join scores n on n.anchor_id = p.anchor_id and not n.same
                and 30 * positive_score <= 100 * n.score and 100 * n.score <= 90 * positive_score)
        select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from negatives where rank <= 10""",
    "op1_jaccard_join": f"""
        with recursive {_sets('docs', 'documents', 'doc_id')},
        sizes as (select doc_id, count(*) as n from docs group by doc_id),
        shared as (select a.doc_id as a, b.doc_id as b, count(*) as k
                   from docs a join docs b on a.s = b.s and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
        links as (select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
        reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on l.a = r.b)
        select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
        from documents d left join sizes using (doc_id) join (select a as doc_id, min(b) as component_id from reach group by a) using (doc_id)""",
    "op7_decontamination": f"""
        with {_sets('docs', 'documents', 'doc_id')}, {_sets('items', 'benchmark', 'item_id')},
        sizes as (select item_id, count(*) as n_item from items group by item_id),
        shared as (select doc_id, item_id, count(*) as n_shared from docs join items using (s) group by doc_id, item_id)
        select doc_id, item_id, n_item, n_shared, n_shared / n_item as containment
        from shared join sizes using (item_id) where 100 * n_shared >= 80 * n_item""",
    "op3_chat_formatting": r"""
        with rows as (
            select conv_id, turn, role, coalesce(text, '') as text from conversations
            union all select -1, k, role, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) v(k, role)),
        escaped as (
            select *, regexp_replace(replace(text, '\', '\s'),
                '(<)(\|turn\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>)|(\[)(INST\]|/INST\])',
                '\1\3\\e\2\4', 'g') as body
            from rows)
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
            coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
            sum(length('<|turn|>') + length(role) + 1 + length(body) + length('<|end|>'))::bigint as formatted_chars
        from escaped group by conv_id""",
}
