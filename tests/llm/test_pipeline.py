"""The pipeline against a plain version of its stages."""

import os
import random
import sys

import plain

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int"


def corpus():
    rng = random.Random(11)
    word = lambda s: "".join(rng.choice(s) for _ in range(rng.randint(2, 6)))
    passage = [word("abcdef") for _ in range(60)]
    item = " ".join(word("abcdef") for _ in range(14))
    rows = []
    for i in range(60):
        lang = "xx" if i % 3 else "yy"
        w = [word("abcdef" if i % 3 else "uvwxyz") for _ in range(rng.randint(1, 80))]
        if i % 7 == 0:
            w[len(w) // 2:len(w) // 2] = passage
        if i % 11 == 0:
            w += item.upper().split()
        rows.append((i, " ".join(w), lang if i % 13 else None, ["a", "b", None][i % 3], 0, 1))
    rows += [(100 + i, rows[i][1] + (" tail" if i % 2 else ""), "xx", "b", 0, 1) for i in range(20)]
    rows += [(200, "12 34 !!", "xx", "a", 0, 1), (201, None, None, None, None, 1), (202, "", "xx", "a", 0, 1), rows[3], (203, item, "xx", "a", 0, 1)]
    return rows, [(1, item), (2, "no such words")]


def plain_run(rows, items, quality):
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]  # every text is of a learned language
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    rows = [rows[i] for i in order]
    rows = [r for i, (r, c) in enumerate(zip(rows, plain.classes([r[1] for r in rows], 5, 80))) if c == i]
    texts = [" ".join(w for j, w in enumerate(plain.words(r[1])) if j not in gone) for r, gone in zip(rows, plain.removed([r[1] for r in rows], 35))]
    rows = [(r, t) for r, t in zip(rows, texts) if t]
    hits = plain.contamination([t for _, t in rows], items, 10)  # words of this corpus are letters only
    texts = [" ".join(w for j, w in enumerate(t.split()) if j not in hit) for (_, t), (hit, _) in zip(rows, hits)]
    rows = [(r[0], r[3], len(t.split()), quality.get(r[0], 1.0)) for (r, _), t in zip(rows, texts) if t]
    taken, _ = plain.mix(rows)
    return sorted((r[0], r[2], t) for r, t in zip(rows, taken) if t)


def test_pipeline(spark, tmp_dir):
    rows, items = corpus()
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    found = sorted((r["doc_id"], r["size"], r["taken"]) for r in corpus_pipeline.run(spark, tmp_dir).collect())
    assert found == plain_run(rows, items, {1: 2.0, 2: 0.5})
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), tmp_dir).columns == corpus_pipeline.COLUMNS
