"""Operators on documents against brute-force versions, over texts with nulls, ties, repeats and very long ones."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import decontaminate, jaccard, katz, pieces, pii, quality, repeats, shards

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, uid string, label string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def texts():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)] + ["Straße", "日本", "naïve", "The", "of", "and"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = [make(rng.choice([3, 5, 12, 40, 90, 200])) for _ in range(30)], make(30)
    out = [None, "", " \t\n", "one", "two words", "four words are here", *base, *base[:6]]
    for text in base[10:25]:
        w = text.split()
        for _ in range(3):
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            out.append(" ".join(v))
    out += [f"{make(20)} {passage} {make(20)}" for _ in range(8)]
    out += [make(6000), make(3000).upper(), "x" * 5000, "ab" * 300, "aİb " * 40, ("the same line here\n" * 40)]
    out += [f"Call +1 (555) 010-{k:04d} or mail u{k}@mail.example.org. Account: ACC-{k:06d}-Z from 10.0.{k}.7" for k in range(8)]
    return out


@pytest.fixture(scope="module")
def rows():
    given = list(enumerate(texts()))
    given += [given[8], given[8], (None, "a text without a name that is long enough to be looked at in all of the ways")]
    return given


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", "u", "l") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                label[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(s), least.get(find(k))) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def in_order(found):
    return sorted(map(tuple, found), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("rounds", [0, 2])
def test_jaccard_components(docs, rows, rounds):
    found = jaccard.similar_documents(docs, rounds).select("doc_id", "n_shingles", "component_id").collect()
    assert in_order(found) == in_order(components(rows))


def test_jaccard_of_a_long_list_that_does_not_link(spark):
    """Hundreds of texts share a passage and little else; some of them have a near copy."""
    rng = random.Random(8)
    words = [f"v{k}" for k in range(5000)]
    passage = " ".join(rng.choice(words) for _ in range(9))
    given = []
    for k in range(400):
        own = [rng.choice(words) for _ in range(rng.choice([3, 60]))]
        given.append((k, " ".join([*own, passage])))
        if k % 10 == 0:
            given.append((1000 + k, " ".join([*own, passage, "end"])))
    found = jaccard.similar_documents(spark.createDataFrame(given, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id").collect()
    expected = components(given)
    assert in_order(found) == in_order(expected) and 10 < sum(c != i for i, _, c in expected)


def test_sketches_never_hide_a_shared_shingle():
    rng = np.random.default_rng(3)
    for n, m, both in [(1, 1, 1), (1, 1, 0), (40, 45, 40), (300, 700, 120), (1000, 1100, 950), (900, 1100, 0)]:
        pool = np.unique(rng.integers(0, 1 << 63, n + m, dtype=np.uint64))[:n + m - both]
        rng.shuffle(pool)
        a, b = np.sort(pool[:n]), np.sort(pool[n - both:n - both + m])
        most = jaccard.most_shared(jaccard.sketch_of(a), jaccard.sketch_of(b), n, m)
        assert both <= most <= min(n, m) and most == jaccard.most_shared(jaccard.sketch_of(b), jaccard.sketch_of(a), m, n)
        assert n < 900 or both or most < 0.5 * n  # unlike sets are told apart


def test_jaccard_keeps_one(docs, rows):
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    by_group = {(c, i) for i, n, c in components(rows) if n}
    expected = {c for c, _ in by_group} | {i for i, n, _ in components(rows) if not n}
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == collections.Counter(expected)


def test_quality_counts(docs, rows):
    def brute(i, text):
        t = text or ""
        w = WORD.findall(t)
        windows = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        return i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed

    found = quality.quality_rules(docs).collect()
    assert in_order(r[:7] for r in found) == in_order(brute(*r) for r in rows)
    assert not any(r["kept"] for r in found if r["base_failed"])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in found)


def test_quality_learns_without_labels():
    good, bad = 0b0000000011, 0b1110000000
    post = quality.fit_posteriors({good: 900, bad: 80, 0b0000000010: 20})
    assert post[good] > 0.9 and post[bad] < 0.1
    assert quality.fit_posteriors({}) == {}


def test_decontamination(spark, docs, rows):
    long = max((t for _, t in rows if t), key=len)
    tests = [(1, " ".join(long.split()[100:130])), (2, "nothing that any text would hold at all here"), (3, None), (4, ""), (5, "two words"),
             (6, " ".join(long.split()[200:240]) + " and some more of it"), (6, " ".join(long.split()[200:240]) + " and some more of it"), (None, "one")]
    items = spark.createDataFrame(tests, "item_id long, text string")
    expected = set()
    for item, text in tests:
        own = shingles(text)
        expected |= {(i, item, len(own), len(own & shingles(t))) for i, t in rows if own and 100 * len(own & shingles(t)) >= 80 * len(own)}
    found = decontaminate.contaminated(docs, items)
    assert {tuple(r) for r in found.select("doc_id", "item_id", "n_item", "n_shared").collect()} == expected and expected
    left = decontaminate.drop_contaminated(docs, items)
    bad = {r[0] for r in expected}
    assert left.columns == docs.columns and sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(i) for i, _ in rows if i not in bad)


def test_pii_base_spans(docs, rows):
    def brute(text):
        spans = []
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
            spans.append(("email", *m.span()))
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
            if all(int(x) <= 255 for x in m.group().split(".")):
                spans.append(("ip", *m.span()))
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            digits = [int(x) for x in m.group() if x.isdigit()][::-1]
            if 16 <= len(digits) <= 19 and sum(sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(digits)) % 10 == 0:
                spans.append(("card", *m.span()))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                spans.append(("phone", *m.span()))
        return spans

    found = pii.find_pii(docs)
    expected = []
    for i, text in rows:
        spans = brute(text or "")
        kinds = collections.Counter(k for k, _, _ in spans)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        expected.append((i, kinds["email"], kinds["ip"], kinds["card"], kinds["phone"], digest))
    assert in_order(found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()) == in_order(expected)
    hidden = pii.redact_pii(docs)
    assert hidden.columns == docs.columns and hidden.count() == len(rows)
    assert not any("@mail.example.org" in (r["text"] or "") for r in hidden.collect())


def test_redaction_does_not_shuffle_texts(spark, tmp_path, monkeypatch):
    """Cut where they are, or joined where there are too many patterns: the same texts."""
    keys = [hashlib.md5(str(k).encode()).hexdigest() for k in range(9)]
    given = [(k, f"mail u{k}@mail.example.org now\napi token {key} kept\nother {keys[0]}", k) for k, key in enumerate(keys)]
    given += [(90, "\u65e5\u672c api token REF-123456 here, api token REF-99-77.", 1), (91, None, None), (92, "", 0), (None, "plain", 2**60 + 1), (93, "call +1 (555) 010-1234", 5), *[(94, f"x {keys[2]}", 3)] * 2]
    docs = spark.createDataFrame([(i, "en", t, n) for i, t, n in given], "doc_id long, lang string, text string, `a.b` long").repartition(3)
    cut = pii.redact_pii(docs)
    assert "Join" not in cut._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(pii, "PATTERNS", -1)
    joined = pii.redact_pii(docs)
    assert cut.columns == docs.columns and in_order(cut.collect()) == in_order(joined.collect())
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[3] == "mail <EMAIL> now\napi token <SECRET> kept\nother <SECRET>"
    assert texts[91] is None and texts[None] == "plain" and texts[93] == "call <PHONE>"


def test_katz_base_and_sums(docs, rows):
    tokens = [[*words(t), None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = collections.Counter(x for own, out in zip(tokens, held) if not out for x in own)
    total, distinct = sum(counts.values()), len(counts)
    expected = [(i, out, len(own), sum(counts[x] > 0 for x in own), total,
                 round(sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in own), 6)) for (i, _), own, out in zip(rows, tokens, held)]
    found = katz.score_texts(docs).collect()
    assert in_order((*r[:5], round(r[5], 6)) for r in found) == in_order(expected)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_katz_rare_words_are_joined(docs, monkeypatch):
    whole = katz.score_texts(docs).collect()
    monkeypatch.setattr(katz, "KNOWN", 20)
    few = katz.score_texts(docs).collect()
    assert in_order((*r[:5], round(r[5], 6)) for r in whole) == in_order((*r[:5], round(r[5], 6)) for r in few)


@pytest.mark.parametrize("known", [katz.KNOWN, 40, 1])
@pytest.mark.parametrize("chunk", [katz.CHUNK, 900])
def test_katz_every_word_has_its_bigrams(spark, monkeypatch, known, chunk):
    """Against a plain model of all words, however few of them are told to the tasks."""
    monkeypatch.setattr(katz, "KNOWN", known)
    monkeypatch.setattr(katz, "CHUNK", chunk)
    rng = random.Random(11)
    given = [(i, " ".join(rng.choice([f"w{int(rng.expovariate(0.03))}", f"x{rng.randrange(400)}", "the", "of"]) for _ in range(rng.randrange(60))))
             for i in range(120)] + [(None, "x1 x2 w3"), (7, "never-met-word the"), (7, None)]
    tokens = [["", *words(t), ""] for _, t in given]  # an end in front, and one behind
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in given]
    unigrams = collections.Counter(x for own, out in zip(tokens, held) if not out for x in own[1:])
    bigrams = collections.Counter(p for own, out in zip(tokens, held) if not out for p in zip(own, own[1:]))
    ratio = lambda counts: katz.good_turing(np.array([0, *[sum(c == r for c in counts.values()) for r in range(1, 7)]], dtype=float))
    total, d1, d2 = sum(unigrams.values()), ratio(unigrams), ratio(bigrams)
    p = {w: c * (d1[c] if c <= 5 else 1) / total for w, c in unigrams.items()}
    rest = max(1 - sum(p.values()), 1 / (total + 1))
    p = {w: x * (1 - rest) / sum(p.values()) for w, x in p.items()}
    after = collections.defaultdict(dict)
    for (a, b), c in bigrams.items():
        after[a][b] = c

    def probability(a, b):
        if a not in after:
            return p.get(b, rest)
        size = sum(after[a].values())
        kept = {w: c * (d2[c] if c <= 5 else 1) for w, c in after[a].items()}
        scale = min(1, size / (size + 1) / (sum(kept.values()) / size)) / size
        if b in kept:
            return kept[b] * scale
        return (1 - sum(kept.values()) * scale) / max(1e-12, 1 - sum(p[w] for w in kept)) * p.get(b, rest)

    assert abs(sum(probability("x1", w) for w in unigrams) + probability("x1", "unknown") - 1) < 1e-9
    expected = [(i, len(own) - 1, round(sum(math.log10(probability(*x)) for x in zip(own, own[1:])), 6)) for (i, _), own in zip(given, tokens)]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    found = katz.score_texts(docs).collect()
    assert in_order((r["doc_id"], r["n_tokens"], round(r["score"], 6)) for r in found) == in_order(expected)


def test_katz_context_sums_to_one():
    import numpy as np

    n = np.array([[4.0, 0], [2, 1], [1, 0], [0, 0], [0, 0]])
    factor, back = katz.context_weights(np.array([0, 1]), n, np.array([12.0, 9.0]), np.array([0.4, 0.2]), np.array([1, .5, .7, .8, .9, .95]))
    for k, d in enumerate((4 * .5 + 2 * 2 * .7 + 3 * .8 + 12, 2 * .7 + 9)):
        assert abs(d * 10 ** factor[k] + 10 ** back[k] * (1 - (0.4, 0.2)[k]) - 1) < 1e-12


@pytest.mark.parametrize("heavy", [repeats.HEAVY, 1])
def test_repeats(docs, rows, heavy):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - 49):
            own = math.inf if i is None else i
            first[data[k:k + 50]] = min(own, first.get(data[k:k + 50], math.inf))
    expected = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if first[data[k:k + 50]] < (math.inf if i is None else i):
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone) if not g)
        expected.append((i, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    found = repeats.without_repeats(docs, heavy).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert in_order(found) == in_order(expected)


def test_maximal_repeats_give_all_occurrences():
    given = [b"xabcabcy", b"zabcabcz", b"abc"]
    text, offset, common, before = repeats.suffixes(given, 3)
    found = {given[text[a]][offset[a]:offset[a] + n]: {(int(text[k]), int(offset[k])) for k in range(a, b + 1)}
             for n, a, b in repeats.maximal_repeats(common, before, 3)}
    assert found == {b"abc": {(0, 1), (0, 4), (1, 1), (1, 4), (2, 0)}, b"abcabc": {(0, 1), (1, 1)}}


@pytest.mark.parametrize("bucket", [jaccard._BUCKET, 1 << 11])
def test_shared_lists_are_told_by_a_bitmap(spark, monkeypatch, bucket):
    from helixframe.llm.bitmaps import is_set

    monkeypatch.setattr(jaccard, "_BUCKET", bucket)
    rng = np.random.default_rng(6)
    once, often = rng.integers(-1 << 63, 1 << 63, 30000), rng.integers(-1 << 63, 1 << 63, 300)
    given = [(np.concatenate([some, often[k::3]]).tobytes(), often[k % 2::2].tobytes()) for k, some in enumerate(np.split(once, 6))] + [(b"", b"")]
    entries = spark.createDataFrame(given, "lists binary, subsets binary").repartition(3)
    bitmap = jaccard._shared_bits(entries, 30000 + 1500)
    assert is_set(bitmap, often).all() and is_set(bitmap, once).mean() < 0.05
    assert not jaccard._shared_bits(entries.limit(0), 0).any()


def test_sets_are_not_moved_to_be_put_on_lists(spark, docs, monkeypatch):
    plans, staged = {}, jaccard.stage

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, label)

    monkeypatch.setattr(jaccard, "stage", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        jaccard.similar_documents(docs).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [x for label in ("shared-lists", "list-members") for x in plans[label].splitlines() if "Exchange" in x and "subsets" in x]
    assert "subsets" not in plans["list-members"] and "Exchange" not in plans["list-entries"]


def test_repeats_of_a_task_take_memory_as_their_suffixes_do():
    import tracemalloc

    rng = random.Random(3)
    given = [rng.randbytes(113) for _ in range(1500)]
    tracemalloc.start()
    try:
        text, offset, common, before = repeats.suffixes(given, 50)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(text) == 1500 * 64 and peak < 6 * 113 * len(text)


def test_parts_of_a_piece_do_not_meet():
    import pandas as pd

    rng = random.Random(4)
    a, b = rng.randbytes(60), rng.randbytes(55)
    given = [a, b, a + b"-" + b, b"x" + a[:52], a]
    group = pd.DataFrame({"piece": given, "doc": [3, 1, 5, 4, 2], "p1": range(5), "p2": range(5)})
    found = sorted(repeats._repeats(group)[["p1", "offset", "length"]].itertuples(index=False, name=None))
    assert found == [(0, 0, 60), (2, 0, 60), (2, 61, 55), (3, 1, 52)]
    assert not len(repeats._repeats(group[:1]))


def test_shards_hold_every_sequence_once(spark, docs, rows, tmp_path):
    import tiktoken

    manifest = shards.write_shards(docs, f"file://{tmp_path}/shards", length=16, per_shard=64)
    found = shards.read_shards(manifest, length=16).collect()
    assert sorted(r["slot"] for r in found) == list(range(len(found)))
    bpe = shards.Tokenizer(shards.RANKS).bpe
    assert isinstance(bpe, tiktoken.Encoding)
    expected = []
    for i, text in rows:
        ids = bpe.encode_ordinary(text or "")
        for k in range(0, len(ids), 16):
            body = b"".join(x.to_bytes(2, "little") for x in ids[k:k + 16])
            expected.append((i, k // 16, len(body) // 2, zlib.crc32(body)))
    assert in_order(r[1:] for r in found) == in_order(expected)
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["slot"])] != sorted((r["doc_id"] or 0) for r in found)
    later = shards.read_shards(manifest, length=16, start=100).collect()
    assert in_order(later) == in_order(r for r in found if r["slot"] >= 100)


def test_feistel_permutes():
    import numpy as np

    for size in (1, 2, 3, 1000, 1025):
        assert sorted(shards.feistel(np.arange(size), size, "k")) == list(range(size))


def test_pieces_round_trip(docs, rows):
    encoded = pieces.encode_pieces(docs)
    found = encoded.collect()
    assert len(found) == len(rows) and all(r["n_pieces"] == len(r["ids"]) for r in found)
    assert all(r["exact"] for r in found if r["doc_id"] is not None and rows[r["doc_id"]][1] == "two words")
    assert pieces.decode_pieces(encoded).count() == len(rows)


@pytest.mark.parametrize("operator", [
    jaccard.similar_documents, jaccard.keep_one, quality.quality_rules, quality.keep_good, pii.find_pii, pii.redact_pii, katz.score_texts,
    repeats.without_repeats, pieces.encode_pieces, lambda d: decontaminate.contaminated(d, d.withColumnRenamed("doc_id", "item_id")),
    lambda d: shards.training_order(d.sparkSession, d)])
def test_empty_tables(empty, operator):
    assert operator(empty).count() == 0


def test_only_null_texts(spark):
    nulls = spark.createDataFrame([(1, None), (2, None), (None, None)], "doc_id long, text string")
    assert {r["component_id"] for r in jaccard.similar_documents(nulls).where(F.col("doc_id").isNotNull()).collect()} == {1, 2}
    assert repeats.without_repeats(nulls).agg(F.sum("n_removed")).first()[0] == 0
    assert katz.score_texts(nulls).count() == 3 and pii.find_pii(nulls).count() == 3
