"""Filter audit, prefix counts and the Merkle manifest against brute force."""

import hashlib
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldlens.llm import filter_audit, merkle, token_counts
from fieldlens.llm.queries import ORACLE, QUERIES

from .conftest import edge_rows, table
from .test_sql_parity import compare, write

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ filter audit
@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 31, 1000, 10_007])
def test_positional_popcount(n):
    words = [random.Random(i).getrandbits(32) for i in range(n)]
    assert filter_audit.positional_popcount(words) == [sum(w >> b & 1 for w in words) for b in range(32)]


def test_survival_words_are_the_truth_table(spark):
    for k in range(1, 6):
        rows = spark.createDataFrame([(m, *[bool(m >> i & 1) for i in range(k)]) for m in range(1 << k)],
                                     "m int, " + ", ".join(f"f{i} boolean" for i in range(k)))
        got = {r["m"]: r["w"] for r in rows.select("m", filter_audit.survival_word([F.col(f"f{i}") for i in range(k)]).alias("w")).collect()}
        assert got == {m: sum(1 << s for s in range(1 << k) if not s & m) for m in range(1 << k)}
    with pytest.raises(ValueError):
        filter_audit.survival_word([F.lit(True)] * 6)


def brute_audit(rows, letters):
    """Applies every order to (part, failed letters, good, toxic) rows, one document at a time."""
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        made = []
        for order in itertools.permutations(letters):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                kept = [r for r in left if f not in r[1]]
                made.append(("".join(order), step, f, len(kept), len(gone), sum(f in r[1] for r in own) - len(gone),
                             sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)))
                left = kept
        shapley = Counter()
        for m in made:
            shapley[m[2]] += m[4]
        out |= {(part, *m[:2]): (*m[3:], shapley[m[2]]) for m in made}
    return out


def test_audit_of_three_filters_over_hot_groups(spark, docs, tmp_dir, monkeypatch):
    """A third of all rows are one text, a third of the ids are equal, and both ways of joining are taken."""
    rng = random.Random(4)
    texts = ["HOT $"] * 60 + ["one two", "TWO", "three $", "", None] * 6 + [f"own {i}" for i in range(60)]
    data = [(i if rng.random() < .6 else rng.choice([7, None]), t, rng.choice(["en", "", None, "fr"]), "s", 0) for i, t in enumerate(texts)]
    labels = [(i, rng.randint(0, 1), rng.choice([0, 1, None])) for i in range(150)] + [(7, 1, 1), (None, 1, 1)]
    frame = docs(data).withColumns({c: F.lit("clash") for c in ("id", "part", "digest", "again", "label", "word", "f_A", "n", "__n")})
    filters = {"A": lambda t: F.length(t) < 5, "B": lambda t: t.contains("$")}
    first = {}
    for i, t, *_ in data:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    flag = lambda k, i: int(any(r[0] == i and r[k] == 1 for r in labels)) if i is not None else 0
    rows = []
    for i, t, lang, *_ in data:
        t = t or ""
        fails = {f for f, bad in (("A", len(t) < 5), ("B", "$" in t), ("C", i is not None and i > first[t])) if bad}
        rows.append((lang or "", fails, flag(1, i), flag(2, i)))
    want = brute_audit(rows, "ABC")
    for hot in (3, 10_000_000):   # few groups are hot; none is
        monkeypatch.setattr(filter_audit, "HOT", hot)
        words = filter_audit.survival(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), filters, "C")
        assert words.count() == len(data)
        out = filter_audit.audit(filter_audit.subset_survivors(words), "ABC").collect()
        got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (
            "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in out}
        assert got == want


# ------------------------------------------------------------------ token counts
@pytest.fixture(scope="module")
def coder():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.Counter(path), Tokenizer.from_file(path)


ODD = ["a  b", " lead", "trail ", "tab\t x", "it's we'll 12½ ²x", "日本語 text", "nbsp x", "x\u0085y \x1c z", "<|endoftext|> a", "é —“q”",
       "\n\n a\n b  \n", "don't  stop", "ÀÉ×÷ßſ K", "a <|endoftext|><|endoftext|> b  <|endoftext|>\n\nx'reader's", "!'s 's\n's  's", "'", "''s'll'lx'.",
       "🙂🙂 x🙂", "a" * 18, "=" * 21 + "-" * 10, "x​y 　 z", "_a_ __b", "1234567 12a34", "٣٤ ४५ ⅷ", "́combining é", "\x00\x01 a\x7f",
       "\n" * 30 + " " * 40 + "x", "١'s", "<|endoftext|", ""]


def test_every_prefix_equals_the_library(coder):
    counter, lib = coder
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("aabcdeist'l r\n\t  !.-=é日½1290_AB") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    for t, s in zip(texts, counter.steps(texts)):
        want = [len(lib.encode(t[:k], add_special_tokens=False).ids) for k in range(len(t) + 1)]
        assert [token_counts.prefix_count(s, k) for k in range(len(t) + 1)] == want, t
        for budget in (0, 1, 3, 8, 1000):
            assert token_counts.longest_prefix(s, budget) == max(k for k, n in enumerate(want) if n <= budget), (t, budget)


def test_pieces_are_bounded_and_forgotten(coder, monkeypatch):
    counter, lib = coder
    monkeypatch.setattr(token_counts, "HELD_BYTES", 20_000)
    texts = [" ".join(f"w{i * j}" for j in range(80)) for i in range(40)]
    got = [token_counts.prefix_count(s, 10_000) for t in texts for s in counter.steps([t])]
    assert got == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]
    assert len(counter.young) + len(counter.old) < 600


def test_counts_of_rows(spark, docs, coder, tmp_dir):
    _, lib = coder
    rows = edge_rows() + [(100 + i, t, "en", "a", 0) for i, t in enumerate(ODD)] + [(200, "x" * 100_000, "en", "a", 0), (201, "\n" * 20_000, "en", "a", 0)]
    docs(rows).withColumns({c: F.lit("clash") for c in ("n_bytes", "steps", "n_tokens")}).write.parquet(f"{tmp_dir}/documents.parquet")
    got = sorted(map(tuple, QUERIES["op12_token_counts"](spark, tmp_dir).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=repr)
    n = [len(lib.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    assert got == sorted([(r[0], len((r[1] or "").encode()), k, k > 1024) for r, k in zip(rows, n)], key=repr)
    cut = {r["doc_id"]: r["cut_chars"] for r in QUERIES["op12_token_counts"](spark, tmp_dir).collect()}
    long_text = next(r[1] for r in rows if r[0] == 4)
    assert len(lib.encode(long_text[:cut[4]], add_special_tokens=False).ids) <= 1024 < len(lib.encode(long_text[:cut[4] + 1], add_special_tokens=False).ids)


def test_counts_of_a_table(spark, coder):
    _, lib = coder
    got = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op12_token_counts"](spark, SF).collect()}
    assert got == {r["doc_id"]: len(lib.encode(r["text"] or "", add_special_tokens=False).ids) for r in table(spark, "documents").collect()}


# ------------------------------------------------------------------ Merkle manifest
def test_closed_form_positions_and_paths():
    for n in [*range(1, 40), 63, 64, 65, 127, 128, 129]:
        leaves = [hashlib.sha256(b"%d" % i).digest() for i in range(n)]
        for height in (merkle.height_of(n), merkle.height_of(n) + 2):
            log, now = merkle.append_log(leaves, height), leaves
            for level in range(height + 1):
                assert [log[merkle.position(level, i, n)] for i in range(len(now))] == now
                now = [merkle.parent(*now[i:i + 2]) for i in range(0, len(now), 2)]
            assert len(log) == merkle.position(height, 0, n) + 1
            for i in range(n):
                path = merkle.path_in_block(b"".join(log), i, n, height)
                assert merkle.fold(leaves[i], path) == log[-1]
                assert merkle.fold(leaves[i][::-1], path) != log[-1]


@pytest.mark.parametrize("block", [2, 8])
def test_stages_of_blocks_give_the_same_manifest(spark, tmp_dir, monkeypatch, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    compare(spark, "op13_merkle", SF)
    write(spark, tmp_dir, edge_rows() + [(i, "same", "xx", "a", 1) for i in [4, 4, 4, 5, 5, 6, 8, 9, 10] * 3])
    compare(spark, "op13_merkle", tmp_dir)


def test_manifest_reads_named_columns_only(spark, docs, tmp_dir):
    names = ["grp", "id", "digest", "claim", "at", "total", "block", "log", "path", "above", "subroot", "row", "task", "__tie"]
    docs(edge_rows()).withColumns({c: F.lit("clash") for c in names}).write.parquet(f"{tmp_dir}/documents.parquet")
    rows = QUERIES["op13_merkle"](spark, tmp_dir).collect()
    assert len(rows) == len(edge_rows()) and len({r["root"] for r in rows}) == 1
    assert any(r["verified"] for r in rows) and all(r["verified"] == (r["folded_root"] == r["root"]) for r in rows)


def test_new_queries_have_sql_or_brute_force():
    assert {"op11_filter_audit", "op13_merkle"} <= set(ORACLE) and "op12_token_counts" in QUERIES
