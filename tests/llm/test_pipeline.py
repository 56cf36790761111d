"""The pipeline's rows against its stages in plain Python, and the bound of the labelled rows."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import xxhash
from test_decontam import brute as hits
from test_secrets import TEXTS
from test_simhash import fingerprint, groups

import corpus_pipeline
from tariffloom.llm import packing, quality, secrets, toxicity


def key(text):
    return 42 if text is None else (xxhash.xxh64_intdigest(text.encode(), 42) ^ (1 << 63)) - (1 << 63)


def least_padding(lengths, buckets=packing.BUCKETS):
    """By trying every start of the last bucket."""
    tops = sorted(set(lengths))
    n = [lengths.count(t) for t in tops]
    cost = lambda i, j: sum(n[k] * (tops[j] - tops[k]) for k in range(i, j + 1))
    best = [cost(0, j) for j in range(len(tops))]
    for _ in range(buckets - 1):
        best = [min([best[j], *(best[i - 1] + cost(i, j) for i in range(1, j + 1))]) for j in range(len(tops))]
    return best[-1]


def fixture():
    rng = random.Random(12)
    words = ["".join(rng.choice("abdeiklmorstu") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    bench = [(k, line(20)) for k in range(5)]
    docs, labels = [], []
    for k in range(240):
        text = line(rng.choice([5, 15, 30, 60]))
        if k % 6 == 0:
            text += " grunx vlompf " + line(3) + " grunx"
        elif k % 6 == 1 and docs:
            text = rng.choice(docs)[1]
        elif k % 6 == 2:
            text += " " + bench[k % 5][1] + " "
        elif k % 6 == 3:
            text += " " + rng.choice(TEXTS)
        docs.append((None if k % 40 == 7 else k // 2 if k % 40 == 9 else k, text))
        labels.append((k, 1, int("grunx" in text)))
    return [*docs, (300, None), (301, ""), (301, ""), (None, None)], labels, bench


def test_rows_of_the_pipeline(spark, tmp_path):
    docs, labels, bench = fixture()
    for name, rows, schema in (("documents", docs, "doc_id long, text string"), ("labels", labels, "doc_id long, quality int, toxic int"),
                               ("benchmark", bench, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    read = lambda name: spark.read.parquet(str(tmp_path / f"{name}.parquet"))

    model = toxicity.train(read("documents"), read("labels"))
    weights, sizes = toxicity.Weights(model.lexicon), [len(docs)]
    rows = [(i, t) for i, t in docs if model.score(np.array([toxicity.features((t or "").encode(), weights)], float))[0] < 0.5]
    sizes.append(len(rows))
    of, heads = groups([fingerprint(t) for _, t in rows]), defaultdict(list)
    for i, t in rows:
        heads[of[fingerprint(t)]].append((i is None, i or 0, key(t), i, t))
    rows = [min(each, key=lambda r: r[:3])[3:] for each in heads.values()]
    sizes.append(len(rows))
    rows = [row for row, (_, n, hit, *_) in zip(rows, hits(rows, bench)) if not (hit and 20 * hit >= n)]
    sizes.append(len(rows))
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == 4  # each of the filters drops some

    novelty, hidden = secrets.Novelty(), []
    for i, t in rows:
        spans = secrets.base_spans(t or "")
        spans = sorted(spans + novelty.spans(t or "", spans))
        hidden.append((i, secrets.masked(t, spans, "[SECRET]") if spans else t))
    assert hidden != rows
    lengths = [(i, len((t or "").split())) for i, t in hidden]

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, ((r.doc_id, r.length) for r in got))) == sorted(map(str, lengths))
    assert all(r.padding == r.bucket_len - r.length >= 0 for r in got)
    assert sum(r.padding for r in got) == least_padding([n for _, n in lengths])
    assert len({(r.bucket, r.batch, r.slot) for r in got}) == len(got)
    assert all((r.slot + 1) * r.bucket_len <= packing.BUDGET for r in got)


def test_labelled_rows_are_bounded_where_an_id_repeats(spark, monkeypatch):
    docs = spark.createDataFrame([(k if k < 30 else 5, f"text {k}") for k in range(400)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(30)], "doc_id long, quality int, toxic int")
    rows = toxicity.training_rows(docs, labels, 30, held_out=False)
    texts = [r.text for r in rows.collect()]
    assert len(texts) == 30
    assert min((f"text {k}" for k in (5, *range(30, 400))), key=key) in texts
    seen = []
    monkeypatch.setattr(quality, "measured", lambda rows, *a: seen.append(rows.count()) or measured(rows, *a))
    quality.learn(docs, labels, 30)
    assert seen == [30]


measured = quality.measured
