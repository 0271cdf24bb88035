"""The operators on texts against brute force: over the small table with rows that are null, empty, repeated or alike."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from oracle import SF_DIR
from tokenizers import Tokenizer

from helmtrack.llm import bpe, exact_dedup, jaccard, langid, lm_score, packing, suffix_dedup, toxicity

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, n_bytes string"
LONG = " ".join(f"word{i % 977} other{i % 13}" for i in range(9000))
ODD = [
    (900001, None, "en", "x"),
    (900002, "", None, None),
    (900003, "a", "en", "x"),
    (900004, "Same Text Here é ñ <|endoftext|> don't  stop\n\n x", "en", "x"),
    (900005, "same text here é ñ <|endoftext|> don't  stop\n\n x", None, "x"),
    (900006, LONG, "en", "x"),
    (900007, LONG + " tail", "en", "x"),
    (900008, "12345 !!! \t\n", "en", "x"),
    (900009, "ééé日本語" * 30, "en", "x"),
    (900010, "z" + "ééé日本語" * 30, "en", "x"),
]


@pytest.fixture(scope="module")
def rows(spark):
    small = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").collect()
    return [(r.doc_id, r.text, r.lang, "clash") for r in small] + ODD


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def encoded(rows):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t, *_ in rows}


def test_bpe_ids_are_those_of_the_library(docs, rows, encoded, nothing):
    tokenizer, ids = encoded
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_round_trip_digest(docs, VOCABULARY).collect()}
    assert got == {i: (len(x), sha(np.array(x, "<u4").tobytes()), sha(tokenizer.decode(x, skip_special_tokens=False).encode())) for i, x in ids.items()}
    assert bpe.bpe_round_trip_digest(nothing, VOCABULARY).count() == 0


def test_packing_places_every_id_once(docs, encoded, nothing):
    ids = {i: [*x, 1] for i, x in encoded[1].items()}
    pieces, filled = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, VOCABULARY, 1, 2048).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.length > 0 and len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        filled[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for parts, whole in [(p, len(ids[i])) for i, p in pieces.items()] + [(p, None) for p in filled.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == whole if whole is not None else at <= 2048
    total = sum(map(len, ids.values()))
    assert sum(len(f) for f in filled.values()) >= len(ids) and len(filled) <= 1.1 * total / 2048 + 2
    assert packing.pack(nothing, VOCABULARY, 1, 2048).count() == 0


def test_suffix_dedup_removes_what_starts_in_an_earlier_document(docs, rows, nothing):
    first: dict[bytes, int] = {}
    texts = {i: (t or "").encode() for i, t, *_ in rows}
    for i in sorted(texts):
        for p in range(len(texts[i]) - 49):
            first.setdefault(texts[i][p : p + 50], i)
    wanted = {}
    for i, t in texts.items():
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(t, gone) if not g)
        wanted[i] = (len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == wanted
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def components(sets: dict, num: int, den: int) -> dict:
    label = {i: i for i in sets}
    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if den * common >= num * (len(sets[a]) + len(sets[b]) - common) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    return label


def sets_of(rows, k: int) -> dict:
    out = {}
    for i, t, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
        out[i] = {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
    return out


@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (5, 4, 5)])
def test_jaccard_components(docs, rows, nothing, k, num, den):
    sets = sets_of(rows, k)
    label = components(sets, num, den)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, k, num, den).collect()}
    assert got == {i: (len(s), label[i]) for i, s in sets.items()}
    assert jaccard.jaccard_components(nothing, k, num, den).count() == 0


def test_jaccard_of_slowly_changing_and_large_groups(spark, monkeypatch):
    """Chains in which neighbours alone are similar, also where tiles take many rounds and blocks."""
    words = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(words[i : i + 100])) for i in range(0, 40, 2)] + [(100 + i, " ".join(words[:50] + [f"x{i}"])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = sets_of(rows, 4)
    wanted = components(sets, 85, 100)
    for block, pivots in ((256, 64), (7, 1)):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        monkeypatch.setattr(jaccard, "PIVOTS", pivots)
        assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, 4, 85, 100).collect()} == wanted


def test_null_and_repeated_identifiers_lose_no_text(spark):
    """Each text that is similar to no other stays, through both stages, whatever its identifier."""
    a, b, c, d, e, f, g = (" ".join(f"{letter}{i}" for i in range(60)) for letter in "abcdefg")
    rows = [(None, a), (None, a + " tail"), (None, a), (None, b), (None, b.upper()), (5, c), (5, d), (3, d + " tail")]
    rows += [(None, e), (7, e + " tail"), (8, e + " end"), (None, f), (9, f), (4, g), (4, g), (None, "one two"), (None, ""), (2, None), (6, " ")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, note int").repartition(3)

    found = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    assert found == set(rows)
    got = defaultdict(set)
    for r in jaccard.jaccard_components(docs, 5, 4, 5).collect():
        got[r.doc_id].add(r.component_id)
    assert got == {None: {None, 7, 9}, 5: {5, 3}, 3: {3}, 7: {7}, 8: {7}, 9: {9}, 4: {4}, 2: {2}, 6: {6}}

    def outcome(left):
        assert left.columns == docs.columns
        return sorted((r.doc_id or 0, "A" if r.text in (a, a + " tail") else (r.text or "").lower()) for r in left.collect())

    similar = [(0, "A"), (0, b), (5, c), (3, d + " tail"), (7, e + " tail"), (4, g), (0, "one two"), (6, " ")]
    assert outcome(jaccard.without_similar(docs)) == sorted([*similar, (9, f), (0, ""), (2, "")])
    assert outcome(jaccard.without_similar(exact_dedup.without_copies(docs))) == sorted([*similar, (0, f), (0, "")])


def test_similar_sets_meet_in_a_tile():
    """Of random pairs about the threshold, each similar one shares a leading shingle, in bands next to each other."""
    rng = np.random.default_rng(5)
    for num, den in ((85, 100), (4, 5), (1, 2)):
        limit = jaccard.Threshold(num, den)
        for n in (1, 2, 5, 12, 40, 100, 333, 1000):
            for _ in range(60):
                base = rng.permutation(4 * n + 8)
                other = max(1, n - int(rng.integers(0, n // 6 + 1)))
                skip = int(rng.integers(0, n // 8 + 1))
                b, a = sorted((np.sort(base[:n]), np.sort(base[skip : skip + other])), key=len)[::-1]
                common = len(np.intersect1d(a, b))
                if limit.similar(common, len(a), len(b)) and common < len(b):
                    sizes = np.array([len(a), len(b)])
                    small, large = limit.leading(sizes)
                    assert set(a[: small[0]]) & set(b[: large[1]])
                    assert np.diff(limit.bands(sizes))[0] in (0, 1)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_groups(docs, rows, nothing, keep):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[lowered(t)].append(i)
    choose = min if keep == "smallest" else max
    wanted = {i: (choose(g), len(g), i == choose(g), sha(t.encode())) for t, g in groups.items() for i in g}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(docs, keep).collect()}
    assert got == wanted
    assert exact_dedup.exact_dedup(nothing, keep).count() == 0
    assert exact_dedup.without_copies(docs, keep).columns == docs.columns


def test_repeated_rows_of_an_identifier(spark):
    rows = [(7, "same words"), (7, "same words"), (3, "Same words"), (None, "SAME words"), (9, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = exact_dedup.exact_dedup(docs, "largest").collect()
    assert sorted((r.doc_id or -1, r.keep_id, r.group_size) for r in found) == [(-1, 7, 4), (3, 7, 4), (7, 7, 4), (7, 7, 4), (8, 9, 2), (9, 9, 2)]
    assert sum(r.kept for r in found) == 2


def test_language_of_held_out_documents(docs, rows, nothing):
    got = {r.doc_id: r for r in langid.language_held_out(docs).collect()}
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {i for i, r in got.items() if r.held_out} == held and len(got) == len(rows)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {got[i].lang_pred for i in (900001, 900002, 900008)} == {"und"}
    judged = [(got[i].lang_pred, lang) for i, t, lang, _ in rows if i in held and lang and i < 900000 and t and re.search(r"[^\W\d_]", t)]
    assert sum(a == b for a, b in judged) >= 0.9 * len(judged)
    assert langid.language_held_out(nothing).count() == 0


@pytest.mark.parametrize(("size", "recall"), [("sf0.01", 0.25), ("sf0.1", 0.75)])
def test_toxicity_of_held_out_documents(spark, nothing, size, recall):
    """With 33 toxic labels to learn from, and with 305."""
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{size}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.toxicity_held_out(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and r.doc_id in got and got[r.doc_id].held_out}
    toxic, plain = ([got[i].score for i, y in truth.items() if y == k] for k in (1, 0))
    print(size, "found", sum(x >= 0.7 for x in toxic), "of", len(toxic), "flagged", sum(x >= 0.7 for x in plain), "of", len(plain))
    assert sum(got[i].predicted == y for i, y in truth.items()) >= 0.88 * len(truth)
    assert sum(x >= 0.7 for x in toxic) >= recall * len(toxic)
    assert sum(x >= 0.7 for x in plain) <= 0.02 * len(plain)
    assert np.mean(np.subtract.outer(toxic, plain) > 0) >= 0.8
    assert toxicity.toxicity_held_out(nothing.select("doc_id", "text"), labels).count() == 0


def test_toxicity_of_odd_rows(spark):
    """Null and empty texts, repeated rows, clashing labels, labels of one class only."""
    rows = [(i, f"calm{i} words number {i} here", "x") for i in range(40)] + [(100 + i, f"some{i} scum word {i}", "x") for i in range(20)]
    rows += [(200, None, "x"), (201, "", "x"), (None, "again scum", "x"), (100, "some0 scum word 0", "x"), (202, LONG, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i >= 100), 0) for i, *_ in rows[:60]] + [(100, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id long, toxic int, h int")
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[200] == score[201] < score[101] and max(score[i] for i in range(40)) < min(score[100 + i] for i in range(20)) and score[None] > score[0]
    one_class = toxicity.toxicity_scores(docs, labels.where("toxic = 0")).collect()
    assert {(r.score, r.predicted) for r in one_class} == {(0.0, 0)}


def test_backoff_scores_of_no_documents(nothing):
    assert lm_score.lm_scores(nothing).count() == 0
