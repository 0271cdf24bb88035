from __future__ import annotations

import re
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from helmtrack.llm import toxicity
from helmtrack.llm.common import read, written

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = read(spark, SF_DIR, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), f"test-{name}")
        out.append(docs)
    return out


def test_stages_keep_the_columns_of_documents(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_each_stage_takes_effect(stages):
    counts = [s.count() for s in stages[:-1]]
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4]
    again = [" ".join((r.text or "").lower().split()) for r in stages[2].collect()]
    assert len(set(again)) >= 0.99 * len(again)


def test_every_kept_document_is_packed(stages):
    assert {r.doc_id for r in stages[-1].select("doc_id").collect()} == {r.doc_id for r in stages[-2].collect()}


def test_run_against_brute_force(spark, tmp_path):
    """Planted toxic texts, copies, near copies and passages, nulls, repeated and empty rows, a clashing column."""
    base = [" ".join(f"{letter}{i}{(i * 7919 + n) % 101}" for i in range(80)) for n, letter in enumerate("abcdefghijkl")]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20, base[0].upper()), (21, base[1]), (22, base[2] + " tail"), (23, "head " + base[2]), (24, base[3][:300] + " " + base[4][:120] + " own words"), (24, "another text under one identifier, unlike all others")]
    rows += [(25, None), (26, ""), (27, "one two"), (5, base[5]), (None, base[6]), (None, "nameless " + " ".join(f"q{i}" for i in range(30)))]
    rows += [(100 + i, f"plain{i} words about item{i} today") for i in range(40)] + [(200 + i, f"some{i} scum near thing{i} here") for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row long")
    labels = spark.createDataFrame([(i, 1, int(i >= 200)) for i in [*range(100, 140), *range(200, 220)]], "doc_id long, quality int, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))

    judged = toxicity.toxicity_scores(docs, labels.where(toxicity.remainder("doc_id", 3) != 1)).groupBy("doc_id").max("predicted").collect()
    toxic = {r[0] for r in judged if r[1]}
    assert {i for i in toxic if i is not None and i >= 200} and not {i for i in toxic if i is not None and i < 200}
    left = [(i, t or "") for i, t in rows if i not in toxic]
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    rank = lambda i: (-1 if i is None else i)
    groups = defaultdict(list)
    for i, t in left:
        groups[fold(t)].append((rank(i), t))
    left = [min(g) for g in groups.values()]

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", fold(t))
        return {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in left]
    label = list(range(len(left)))
    for a in range(len(left)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    named = lambda n: (left[n][0] < 0, left[n][0])  # noqa: E731  null identifiers come last here
    left = [left[min((n for n in range(len(left)) if label[n] == x), key=named)] for x in set(label)]
    first, texts = {}, [(10**9 if i < 0 else i, t.encode()) for i, t in left]
    for i, t in sorted(texts):
        for p in range(len(t) - 49):
            first.setdefault(t[p : p + 50], i)
    wanted = defaultdict(list)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    cut = 0
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        cut += sum(gone)
        kept = bytes(b for b, g in zip(t, gone) if not g).decode("utf-8", "ignore")
        wanted[None if i == 10**9 else i].append(len(tokenizer.encode(kept, add_special_tokens=False).ids) + 1)
    assert cut
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        assert r.offset + r.length <= 2048
        if r.start + r.length == r.doc_tokens:
            got[r.doc_id].append(r.doc_tokens)
    assert {i: sorted(n) for i, n in got.items()} == {i: sorted(n) for i, n in wanted.items()}
