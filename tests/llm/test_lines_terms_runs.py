"""Line dedup, source divergence and periodic runs against brute force, over rows that are null, empty, repeated or alike."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest

from helmtrack.llm import divergence, line_dedup, periodic

BLANKS = " \t\n\x0b\x0c\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def line_key(line: str) -> str:
    return lowered(line.strip(BLANKS))


SHARED = "This line of forty characters or more is shared by all"
FORTY, SHORT = "é" * 40, "É" * 39
CLASHING = "doc_id long, text string, runs string, row string, digest long, doc int, place int, key string, a int"


def line_rows() -> list:
    texts = [
        f"{SHARED}\nown line {SHARED} 1\n{SHARED}",
        f"  {SHARED.upper()}\t\r\n{FORTY}\n{SHORT}",
        f"{FORTY}\n\x0b{SHARED}\x0c\n\n\n",
        f"{SHARED}\n{FORTY}\n{SHORT}",
        f"{SHORT}\n{FORTY}",
        f"{FORTY}",
        f"tail\n{SHARED}\n{SHARED} \n{FORTY.upper()}\n{SHORT}",
        None,
        "",
        "\n",
        f"{SHORT}\n{SHARED}",
        "word " * 40_000 + f"\n{SHARED}\n" + "\n".join(f"a line of its own, long enough to be looked at, number {i}" for i in range(5_000)),
        f"four documents share this line and that is too few {7}\n{SHARED}",
        *([f"four documents share this line and that is too few {7}"] * 3),
    ]
    rows = [(i + 1, t) for i, t in enumerate(texts)]
    rows += [(1, texts[0]), (1, texts[0]), (1, f"another text of the first\n{SHARED}"), (None, f"x\n{SHARED}"), (None, f"y\n{SHARED}")]
    return [(i, t, "r", "row", 5, 6, 7, "k", 8) for i, t in rows]


def brute_lines(rows) -> list:
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key := line_key(line)) >= 40:
                holders[key].add(float("-inf") if i is None else i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        me = float("-inf") if i is None else i
        kept = [x for x in lines if len(holders.get(line_key(x), ())) < 5 or max(holders[line_key(x)]) == me]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


def test_shared_lines_stay_in_the_last_document_alone(spark):
    rows = line_rows()
    docs = spark.createDataFrame(rows, CLASHING).repartition(3)
    got = line_dedup.line_dedup(docs).drop("runs").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_lines(rows)
    assert sum(r.n_dropped for r in got) > 12
    cleaned = line_dedup.without_repeated_lines(docs)
    assert cleaned.columns == docs.columns and cleaned.schema == docs.schema
    texts = Counter((r.doc_id, sha(r.text or "")) for r in cleaned.collect())
    assert texts == Counter((i, digest) for i, _, _, digest in brute_lines(rows))
    assert cleaned.where("text IS NULL").count() == 1


def test_bitmaps_are_run_lengths(spark):
    docs = spark.createDataFrame([(i, "\n".join(["x", "x", *[SHARED] * 3, "y", SHARED, "z"])) for i in range(5)], "doc_id long, text string")
    found = {r.doc: r.runs for r in line_dedup.line_bitmaps(docs).collect()}
    assert found == {i: [2, 3, 1, 1] for i in range(4)}


def test_no_lines(spark):
    docs = spark.createDataFrame([], CLASHING)
    assert line_dedup.line_dedup(docs).count() == 0 and line_dedup.without_repeated_lines(docs).count() == 0


def term_rows() -> list:
    rng = random.Random(4)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnop'[i % 6]}" for i in range(30)] + ["Äh", "äh", "日本", "don't"]
    rows = []
    for i in range(120):
        source = rng.choice([None, "", "one", "ÉTÉ", *(f"s{j}" for j in range(9))])
        rows.append((i, " 12-".join(rng.choices(words, k=rng.randrange(12))).upper() if i % 7 else " ".join(rng.choices(words, k=30)), rng.choice(["en", None, "fr"]), source))
    rows += [(1, None, "en", "silent"), (None, "", "fr", None), (2, "only here", "xx", "p"), (3, "other", "xx", "q"), (3, "other", "xx", "q"), (4, "alone", "yy", "z")]
    rows += [(500 + i, "waa wbb " * 30_000, "en", "one") for i in range(3)]
    return [(*r, 1, 2, 3) for r in rows]


def brute_divergence(rows, min_docs: int, top: int) -> list:
    terms_of = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(t or ""))
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source, terms = lang or "", source or "", terms_of(text)
        groups.add((lang, source))
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        mine = sorted(s for x, s in groups if x == lang)

        def share(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + (10**9 * (counts[t] + 5)) // (n + 5 * len(kept)) for t in kept}

        p = {s: share(count[lang, s]) for s in mine}
        q = share(sum((count[lang, s] for s in mine), Counter()))
        for s in mine:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in mine if o != s)
            own = sorted((q[t] - p[s][t], t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:top]
            for part, items in (("pair", pairs), ("term", own)):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(items, 1)]
    return sorted(out)


@pytest.mark.parametrize(("min_docs", "top"), [(8, 50), (3, 2)])
def test_divergence_of_sources(spark, monkeypatch, min_docs, top):
    """With blocks of four terms and tiles of two groups, so that pairs meet over many tasks."""
    monkeypatch.setattr(divergence, "BLOCK_BITS", 2)
    monkeypatch.setattr(divergence, "TILE", 2)
    rows = term_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n int, term int, value int").repartition(4)
    got = sorted(tuple(r) for r in divergence.source_divergence(docs, min_docs, top).collect())
    assert got == brute_divergence(rows, min_docs, top)
    assert any(r[0] == "xx" and r[2] == "pair" and r[4] == 0 for r in got) and not any(r[0] == "yy" for r in got)


def test_divergence_of_no_documents(spark):
    assert divergence.source_divergence(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0


def test_shares_are_exact_for_large_counts():
    counts = [0, 1, 7, 10**9, 10**12, 3 * 10**15]
    total = sum(counts) + 5 * 123_456
    assert divergence.shares(np.array(counts), total).tolist() == [1 + 10**9 * (c + 5) // total for c in counts]


def brute_runs(words: list) -> list:
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(24, 3 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def periodic_words(rng: random.Random) -> list:
    n, kinds = rng.choice([0, 1, 23, 24, 25, 60, 150, 400]), rng.choice([1, 2, 3, 40])
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 30 else 0):
        start, p = rng.randrange(n - 10), rng.randrange(1, n // 4)
        for i in range(start + p, min(n, start + p * rng.randrange(2, 9))):
            words[i] = words[i - p]
    return words


def test_runs_of_random_sequences():
    rng = random.Random(11)
    for _ in range(500):
        words = periodic_words(rng)
        assert [tuple(r) for r in periodic.find_runs(np.array(words, np.int64)).tolist()] == brute_runs(words)


def test_extensions_by_the_difference_cover():
    """Long common parts of places of all residues, in both kinds of ties, against comparing word by word."""
    part = np.random.default_rng(3).integers(0, 3, 400)
    words = np.concatenate([part, part[:350], [7], part[13:], part])
    lce = periodic.CoverLCE(words)
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, len(words) + 1, (2, 4000))
    x, y = np.concatenate([x, np.arange(300)]), np.concatenate([y, np.arange(300) + 400])
    x, y = x[x != y], y[x != y]

    def plain(i, j):
        k = 0
        while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
            k += 1
        return k

    assert lce.query(x, y).tolist() == [plain(i, j) for i, j in zip(x, y)]
    assert lce.table is not None


def test_long_runs_of_one_word_and_of_few():
    assert periodic.find_runs(np.zeros(50_000, np.int64)).tolist() == [[0, 50_000, 1]]
    assert periodic.find_runs(np.tile(np.arange(701), 40)).tolist() == [[0, 28_040, 701]]


def brute_digest(doc_id, text) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = brute_runs(words)
    lost = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    return doc_id, len(runs), *best, milli, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in lost))


def test_periodic_runs_of_documents(spark):
    rng = random.Random(2)
    rows = [(i, " \t".join(f"w{w}" for w in periodic_words(rng))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n\x0b "), (None, "again " * 40), (7, "again " * 40), (7, "again " * 40), (-5, "é é " * 30), (103, "a b " * 6_000 + "c"), (104, ("x " * 30 + "y z " * 20) * 4)]
    rows = [(*r, 9, "s") for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, runs string").repartition(3)
    got = [tuple(r) for r in periodic.periodic_run_digest(docs).collect()]
    assert sorted(got, key=str) == sorted((brute_digest(i, t) for i, t, *_ in rows), key=str)
    assert sum(g[1] > 0 for g in got) >= 15
    whole = {r.doc_id: r for r in periodic.periodic_runs(docs.where("doc_id = 103")).collect()}
    assert whole[103].collapsed == "a b c" and whole[103].best == [0, 12_000, 2]
    assert periodic.periodic_run_digest(docs.limit(0)).count() == 0


def test_every_offset_leads_into_the_cover():
    for i, j in permutations(range(periodic.MODULUS), 2):
        d = periodic._OFFSET[i, j]
        assert (i + d) % periodic.MODULUS in periodic.COVER and (j + d) % periodic.MODULUS in periodic.COVER
