import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from tallyworks.llm import bpe, mixing
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_ngram_join import brute_links, shingles


@pytest.fixture(scope="module")
def folder(spark, frame, tmp_path_factory):
    """A small folder of tables: clean documents, junk, copies, near copies, repeated passages, odd rows."""
    draw, path = random.Random(11), str(tmp_path_factory.mktemp("tables"))
    words = ["".join(draw.choice("etaoinshrdlu") for _ in range(draw.randint(1, 9))) for _ in range(500)]
    passage = "\n".join(" ".join(draw.choice(words) for _ in range(20)) for _ in range(4))
    rows, labels = [], []
    for doc in range(400):
        lines = [" ".join(draw.choice(words) for _ in range(draw.randint(4, 20))) + "." for _ in range(draw.randint(1, 8))]
        good = draw.random() < 0.8
        text = "\n".join(lines if good else [x.upper().replace(" ", "!! ") for x in lines])
        if good and doc % 9 == 0:
            text += "\n" + passage
        if good and doc % 11 == 0 and rows:
            text = rows[-1][1] if doc % 2 else rows[-1][1].replace(" ", "  ", 1)
            good = labels[-1][1] == 1
        rows.append((doc, text, f"src{draw.choice([0, 0, 0, 1, 2])}"))
        labels.append((doc, int(good)))
    rows += [(None, "a null id with some plain words in it.", None), (900, None, "src1"), (901, "", "src1"), (3, rows[3][1], rows[3][2])]
    frame(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def as_rows(docs):
    return [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]


def test_stages_against_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{n}")
        after = spark.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            assert after.columns == columns
        before, kept = as_rows(docs), as_rows(after) if n < 4 else None
        if name == "quality classifier":
            clean = [r for r in before if r[1] and "!!" not in r[1] and r[0] is not None]
            assert not [r for r in kept if r[1] and "!!" in r[1]]
            assert len([r for r in clean if r in kept]) >= 0.97 * len(clean)
        elif name == "line dedup":
            cleaned = brute_lines([r[:2] for r in before])
            expected = Counter()
            for doc, text, source in before:
                new = cleaned[doc, text]
                if new == text or new.strip(" "):
                    expected[doc, new, source] += 1
            assert Counter(kept) == expected
            assert all(r["n_chars"] == len(r["text"]) for r in after.collect() if r["text"] is not None)
        elif name == "n-gram jaccard join":
            distinct = sorted(set(before), key=repr)
            groups = brute_links([(i, r[1]) for i, r in enumerate(distinct)])
            whole = {}
            for i, r in enumerate(distinct):
                group = groups[i][0] if shingles(r[1]) else ("own", i)
                content = hashlib.md5(f"{'' if r[0] is None else r[0]}|{r[1] or ''}".encode()).hexdigest()[:16]
                whole[group] = min(whole.get(group, (True, 10**9, "~", r)), (r[0] is None, r[0] or 0, content, r), key=lambda x: x[:3])
            assert Counter(kept) == Counter(x[3] for x in whole.values())
        elif name == "mixing sources":
            from tallyworks.workspace import Workspace

            planned = mixing.plan(docs, Workspace(spark, str(tmp_path / "plan"))).collect()
            expected = Counter()
            for r in planned:
                expected[r["doc_id"]] += sum(2 * p["words"] >= r["size"] for p in r["places"])
            assert Counter(r[0] for r in kept) == +expected and set(kept) <= set(before)
        else:
            coder = bpe.coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
            expected = Counter((d, coder.encode(t), hashlib.sha256(t.encode()).hexdigest()) for d, t, _ in before)
            assert Counter((r["doc_id"], bytes(r["ids"]), r["decoded_sha256"]) for r in after.collect()) == expected
        docs = after


def test_run_and_empty_tables(spark, frame, folder, tmp_path):
    rows = corpus_pipeline.run(spark, folder)
    assert rows.count() > 200 and rows.columns[0] == "doc_id"
    empty = str(tmp_path)
    frame([]).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
