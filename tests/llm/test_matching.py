"""Decontamination, near-duplicates, suffix index family and the pipeline, against brute force."""

import math
import random
import re
import struct
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_tables import no_docs, odd_docs  # noqa: F401
from scholarspark.llm import bpe, common, components, decontaminate, lsh_forest, suffix_dedup, toxicity


def words(rng, n):
    return [rng.choice("lo ri mu ta ke sa no vi pe du".split()) + rng.choice("ban dor fel gim hos jur".split())
            + rng.choice(["", "a", "en", "ix"]) for _ in range(n)]


@pytest.fixture(scope="module")
def contaminated(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, rng.randint(15, 50)))) for i in range(30)] + [(98, None), (99, "...")]
    rows, truth = [], set()
    for d in range(200):
        text = words(rng, rng.randint(0, 300))
        if d % 4 == 0:
            k = rng.randrange(30)
            part = [rng.choice(text or ["x"]) if rng.random() < 0.1 else w for w in items[k][1].split()]
            at = rng.randint(0, len(text))
            text[at:at] = part
            truth.add((d, k))
        rows.append((d, " ".join(text)))
    return (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), truth)


def test_contamination(contaminated):
    docs, items, truth = contaminated
    rows = decontaminate.mark_contamination(docs, items).collect()
    found = {(r["doc_id"], h["item_id"]) for r in rows for h in r["hits"]}
    assert len(rows) == 200 and found == truth


def test_contamination_in_a_third_of_the_rows(spark):
    rng = random.Random(6)
    pool = [a + b + c for a in words(rng, 300) for b in "ka lo mi ne".split() for c in "st rd lf gn".split()]
    items = [(i, " ".join(rng.choices(pool, k=45))) for i in range(20)]
    changed = set(rng.sample(range(45), 9))
    paraphrase = [f"other{i}" if i in changed else w for i, w in enumerate(items[7][1].split())]
    rows = []
    for d in range(300):
        text = rng.choices(pool, k=rng.randint(50, 200))
        at = rng.randint(0, len(text))
        rows.append((d, " ".join(text[:at] + (paraphrase if d % 3 == 0 else []) + text[at:])))
    marked = decontaminate.mark_contamination(spark.createDataFrame(rows, "doc_id long, text string"),
                                              spark.createDataFrame(items, "item_id long, text string"))
    found = {(r["doc_id"], h["item_id"]) for r in marked.collect() for h in r["hits"]}
    assert found == {(d, 7) for d in range(0, 300, 3)}


def test_verbatim_items_of_every_length(spark):
    rng = random.Random(8)
    pool = [a + b + c for a in words(rng, 300) for b in "ka lo mi ne".split() for c in "st rd lf gn".split()]
    items = [(i, " ".join(rng.choices(pool, k=1 + i % 20))) for i in range(100)]
    rows = []
    for d in range(200):
        text = rng.choices(pool, k=rng.randint(50, 200))
        at = rng.randint(0, len(text))
        rows.append((d, " ".join(text[:at] + items[d % 100][1].title().split() + text[at:])))
    marked = decontaminate.mark_contamination(spark.createDataFrame(rows, "doc_id long, text string"),
                                              spark.createDataFrame(items, "item_id long, text string"))
    found = {(r["doc_id"], h["item_id"]) for r in marked.collect() for h in r["hits"]}
    assert not {(d, d % 100) for d in range(200)} - found


def test_parts_and_groups_change_nothing(contaminated, monkeypatch):
    """A text cut into overlapping parts, and items searched in several passes, give the hits of one search; clashing names stay."""
    docs, items, _ = contaminated
    long = docs.groupBy((F.col("doc_id") % 3).alias("doc_id")).agg(F.array_join(F.array_sort(F.collect_list("text")), " ").alias("text"))

    def found(df, **options):
        return sorted((r["doc_id"], h["item_id"], h["lcs"], h["answer"], h["word"]) for r in
                      decontaminate.mark_contamination(df.withColumn("hits", F.lit(1)).withColumn("item", F.lit(1)), items, **options).collect()
                      for h in r["hits"])

    whole = found(long)
    assert len({(d, k) for d, k, *_ in whole}) > 30
    monkeypatch.setattr(decontaminate, "BATCH_WORDS", 500)
    assert found(long) == whole
    assert {(d, k) for d, k, *_ in found(docs, at_once=8)} == {(d, k) for d, k, *_ in found(docs)}


def test_the_space_is_fitted_on_the_passages_of_all_documents(spark, monkeypatch):
    """More documents than any sample held; rows may repeat, and a large vocabulary takes some rows of the matrix at a time."""
    rng = random.Random(12)
    vocabulary = sorted({w for w in words(rng, 60)})
    index = {w: i for i, w in enumerate(vocabulary)}
    texts = [" ".join(rng.choice(vocabulary[i % 9:]) if rng.random() < 0.8 else "other" for _ in range(rng.randint(0, 25))) for i in range(3500)]
    texts += [None, "", "..."] + texts[:50]
    idf = np.linspace(0.3, 5.0, len(vocabulary))
    want, frequencies = np.zeros((len(idf), len(idf))), np.zeros(len(idf), int)
    for text in texts:
        own = (text or "").split()
        frequencies[[i for i in range(len(idf)) if vocabulary[i] in own]] += 1
        for at in range(0, len(own), 20):
            x = np.zeros(len(idf))
            for w in own[at:at + 20]:
                if w in index:
                    x[index[w]] += idf[index[w]]
            if x.any():
                want += 2.0 * np.outer(x, x) / (x @ x)
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    encoded = decontaminate.encode_passages(docs, index, 20).withColumn("weight", F.lit(2.0))
    counts, n = decontaminate.document_frequencies(encoded, len(idf))
    assert n == len(texts) and counts.tolist() == frequencies.tolist()

    def matrix():
        out = np.zeros(want.shape)
        for r in decontaminate.shared_terms(encoded, idf).collect():
            out[r["row"], r["row"]:] += np.frombuffer(r["part"])
        return out

    assert np.allclose(matrix(), np.triu(want))
    monkeypatch.setattr(decontaminate, "CELLS", 200)
    assert np.allclose(matrix(), np.triu(want))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    with decontaminate.small_batches(spark):
        assert int(spark.conf.get(key)) == decontaminate.BATCH_BYTES
        latent = decontaminate.fit_latent(encoded, idf, 60)
    assert spark.conf.get(key) == before
    assert np.allclose(latent.T @ want @ latent, np.diag(np.linalg.eigvalsh(want)[::-1][:latent.shape[1]]), atol=1e-6)


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_subsequence(a, b) == table[-1][-1]


def test_contamination_of_odd_rows(contaminated, odd_docs, no_docs):
    _, items, _ = contaminated
    rows = decontaminate.mark_contamination(odd_docs, items).collect()
    assert len(rows) == odd_docs.count() and all(r["hits"] == [] for r in rows)
    assert decontaminate.mark_contamination(no_docs, items).count() == 0
    assert all(r["hits"] == [] for r in decontaminate.mark_contamination(odd_docs, items.limit(0)).collect())


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(i, f"good words number {i} here. " + ("vile " if i % 2 else "nice ") * 3) for i in range(60)] * 2,
                                 "doc_id long, text string").withColumns({c: F.lit(c) for c in ("y", "_id", "_kept", "_rid", "kept", "rid", "row", "_text")})
    labels = spark.createDataFrame([(i, i % 2, 5) for i in range(60)], "doc_id long, toxic int, y int")
    weights, bias = toxicity.train_model(docs, labels, steps=5)
    assert weights["vile"] > 0
    scored = toxicity.score_documents(docs, weights, bias)
    assert scored.columns == [*docs.columns, "score", "offending"] and scored.where("y = 'y' AND _text = '_text'").count() == 120
    assert toxicity.score_documents(docs, weights, bias, columns=["doc_id"]).columns == ["doc_id", "score", "offending"]
    kept = lsh_forest.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("_rid = '_rid' AND _kept = '_kept'").count() == kept.count() > 0


def brute_links(rows):
    sets = []
    for i, t in rows:
        w = re.findall(r"\w+", t.lower()) if t is not None else []
        sets.append(None if t is None else {t} if not w else {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))})
    root, links = list(range(len(rows))), [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] is not None and sets[b] is not None and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                ra, rb = root[a], root[b]
                root = [rb if r == ra else r for r in root]
    least = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=None) for r in root}
    return Counter((i, least[root[k]], links[k]) for k, (i, _) in enumerate(rows))


def near_rows(seed=3):
    rng, rows = random.Random(seed), []
    for base in range(12):
        text = words(rng, rng.randint(8, 120))
        for _ in range(rng.choice([1, 1, 2, 9])):
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 60))):
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates(spark, odd_docs, block, monkeypatch):
    monkeypatch.setattr(lsh_forest, "BLOCK", block)
    rows = near_rows() + [(None if r[0] is None else 1000 + r[0], r[1]) for r in odd_docs.select("doc_id", "text").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lsh_forest.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == brute_links(rows)


def test_keep_one(spark, odd_docs, no_docs):
    kept = lsh_forest.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.select("doc_id", "text").collect()
    assert sum(r["text"] == "Hello, world!" for r in rows) == 1 and sum(r["text"] is None for r in rows) == 2
    assert lsh_forest.keep_one(no_docs).count() == 0 and lsh_forest.near_duplicates(no_docs).count() == 0


def test_depth_follows_the_recall():
    d = lsh_forest.start_depth(0.8, 0.99, 18, 8)
    assert lsh_forest.find_probability(0.8, d, 18) >= 0.99 > lsh_forest.find_probability(0.8, d + 1, 18)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(50)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}


def brute_spans(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[p:p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for (i, _), d in zip(rows, data):
        gone = [False] * len(d)
        for p in range(len(d) - length + 1):
            if seen[d[p:p + length]] > 1:
                gone[p:p + length] = [True] * length
        out.append((i, bytes(b for b, g in zip(d, gone) if not g),
                    sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))))
    return Counter(out)


def repeat_rows():
    rng = random.Random(9)
    passage, period = " ".join(words(rng, 30)), "abcdé" * 60
    rows = []
    for i in range(40):
        text = " ".join(words(rng, rng.randint(0, 60)))
        if i % 3 == 0:
            text += passage[rng.randint(0, 40):] + " ".join(words(rng, 10))
        if i % 10 == 1:
            text = period + text
        rows.append((i, text))
    return rows + [(40, rows[5][1]), (41, rows[5][1]), (5, rows[5][1])]


@pytest.mark.parametrize("length,hot,chunk", [(100, 20_000, 1 << 22), (100, 3, 1 << 22), (100, 20_000, 300), (64, 20_000, 1 << 22),
                                              (20, 20_000, 1 << 22)])
def test_repeats(spark, odd_docs, length, hot, chunk, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    rows = repeat_rows() + [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_spans(suffix_dedup.mark_repeats(df, length=length)).collect()
    assert Counter((r["doc_id"], bytes(r["kept"]), len(r["spans"])) for r in got) == brute_spans(rows, length)


def test_windows_of_a_large_group_take_bounded_memory():
    """8 MB of near copies, as one key may have them: every array over all bytes would take 64 MB, and one a power of two 500."""
    rng = np.random.default_rng(3)
    same = rng.integers(97, 123, 600, np.uint8).tobytes()
    context = [same[:300] + bytes(rng.integers(97, 123, 300, np.uint8)) for _ in range(14_000)] + [same]
    tracemalloc.start()
    h, n = suffix_dedup._windows(context, 240)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100_000_000 and n.tolist() == [361] * 14_001 and len(h) == 361 * 14_001
    owner, inside = suffix_dedup._places(n, np.arange(len(h)))
    assert (owner == np.repeat(np.arange(14_001), 361)).all() and (inside == np.tile(np.arange(361), 14_001)).all()
    for i in (0, 7_000, 14_000):
        alone, = suffix_dedup.gram_hashes(np.frombuffer(context[i], np.uint8), 240)
        assert (h[361 * i:361 * (i + 1)] == alone).all()
    assert len(np.unique(h.reshape(14_001, 361)[:, :61])) == 61      # windows of the shared part, alike in all


def test_repeats_keep_columns(odd_docs, no_docs):
    marked = suffix_dedup.mark_repeats(odd_docs)
    assert set(odd_docs.columns) <= set(marked.columns) and marked.count() == odd_docs.count()
    assert suffix_dedup.mark_repeats(no_docs).count() == 0


def test_levels_merge_geometrically(spark):
    family = suffix_dedup.IndexFamily(spark)
    for b in range(5):
        family.add(spark.createDataFrame([(k, bytes([b]), k, k) for k in range(b, b + 3)], "key long, rep binary, first long, last long"))
    assert [n for n, _ in family.levels] == [4, 1]
    found = {(r["key"], bytes(r["rep"])) for r in family.matches().collect()}
    count = Counter(k for b in range(5) for k in range(b, b + 3))
    assert found == {(k, bytes([b])) for b in range(5) for k in range(b, b + 3) if count[k] > 1}
    family.drop()


def test_pipeline_stages(spark):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "decontamination",
                                                      "byte_level_bpe"]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    assert out.columns == docs.columns
    assert out.count() == len({(k[1]) for k in brute_links(sorted(before.items())).elements()})
    cut = corpus_pipeline.cut_repeats(spark, docs, sf)
    assert cut.dtypes == docs.dtypes
    want = brute_spans(sorted(before.items()), corpus_pipeline.PASSAGE_BYTES)
    assert Counter((r["doc_id"], r["text"]) for r in cut.collect()) == Counter((i, k.decode("utf-8", "ignore")) for i, k, _ in want.elements())
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "n_tokens", "ids"]


def plain_score(text, weights, bias):
    """Noisy-or over the sentences, by the definition."""
    def p(z):
        return 1 / (1 + math.exp(-z))
    rest = 1.0
    for piece in re.split(r"[.!?\n]+", text):
        found = set(re.findall(r"[^\W_]+", piece.lower()))
        if found:
            z = sum(weights.get(f, 0.0) for w in found for f in toxicity.word_features(w))
            rest *= 1 - p(z + bias)
    return 1 - rest


def plain_contaminated(text, items):
    """Whether some window around the size of an item holds enough of its words in order."""
    have = re.findall(r"\w+", text.lower())
    for item in items:
        own, answer = re.findall(r"\w+", item.lower()), decontaminate.answer_of(item)
        if not own:
            continue
        for n in {max(1, round(len(own) / 10)), max(2, round(len(own) / 10 + 0.5))}:
            for at in range(0, len(have), 10):
                passage = have[max(0, at - len(own) // 2 - 10):at + n * 10 + len(own) // 2 + 10]
                held = set(passage)
                if sum(w in held for w in own) < 0.6 * len(own):
                    continue
                share = decontaminate.common_subsequence(own, passage) / len(own)
                if share >= 0.75 or share >= 0.6 and decontaminate.common_subsequence(answer, passage) >= 0.5 * len(answer):
                    return True
    return False


def test_pipeline_equals_a_plain_chain(spark):
    """run() against the five stages in plain Python: which documents are left, and their ids."""
    import corpus_pipeline
    import public_tokenizers
    import tiktoken
    sf = "/root/testdata/sf0.001"
    docs, labels, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    weights, bias = toxicity.train_model(docs, labels)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    rows = [r for r in rows if plain_score(r[1], weights, bias) < 0.7]
    sets = [{tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if (w := re.findall(r"\w+", t.lower())) else {t} for _, t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    rows = [r for k, r in enumerate(rows) if root[k] == k]                        # ascending ids: the least stays
    rows = sorted((i, kept.decode("utf-8", "ignore")) for i, kept, _ in brute_spans(rows, corpus_pipeline.PASSAGE_BYTES).elements())
    texts = [r["text"] for r in items.collect()]
    rows = [r for r in rows if not plain_contaminated(r[1], texts)]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [(i, struct.pack(f"<{len(x)}I", *x)) for i, x in ((i, enc.encode_ordinary(t)) for i, t in rows)]
    assert sorted((r["doc_id"], bytes(r["ids"])) for r in corpus_pipeline.run(spark, sf).collect()) == want and 100 < len(want) < docs.count()


def test_pipeline_decodes_what_it_encodes(spark, odd_docs, monkeypatch):
    import corpus_pipeline
    rows = corpus_pipeline.encode(spark, odd_docs, "").collect()
    path = corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken")
    plain = corpus_pipeline.bpe.encode_documents(odd_docs, path, corpus_pipeline.public_tokenizers.PATTERN)
    assert Counter(map(tuple, rows)) == Counter(map(tuple, plain.collect()))
    real = corpus_pipeline.bpe.encode_documents
    monkeypatch.setattr(corpus_pipeline.bpe, "encode_documents",
                        lambda *a, **k: real(*a, **k).withColumn("decoded", F.concat("decoded", F.lit("x"))))
    with pytest.raises(Exception, match="differs after encoding"):
        corpus_pipeline.encode(spark, odd_docs, "").collect()


def test_workers_give_memory_back():
    """Blocks freed below one that is still held would stay with the process; what another operator left goes, too."""
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    held = []

    def run(batches):
        for _ in batches:
            blocks = [bytes(1000) for _ in range(200_000)]
            held.append(blocks[-1])
            yield len(blocks)

    common.worker_state(("other operator",), lambda: 1)
    before = resident()
    assert list(common.gives_back(run)(iter([0]))) == [200_000]
    assert resident() - before < 100_000_000
    assert common.worker_state(("other operator",), lambda: 2) == 2
    common.release_worker_state()


def test_workers_keep_what_their_operator_needs_again():
    common.worker_state(("own", "table"), lambda: 1)
    assert list(common.gives_back(lambda batches: batches, keep="own")(iter([0]))) == [0]
    assert common.worker_state(("own", "table"), lambda: 2) == 1
    common.release_worker_state()
