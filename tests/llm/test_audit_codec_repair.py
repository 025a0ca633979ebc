"""Filter audit, BPE round trip and conversation repair against brute force."""

import random
import sys
from collections import Counter

import pytest

from tests.conftest import SF
from tests.llm import brute
from tests.llm.test_llm import awkward, base, frame, prose, rows_of  # noqa: F401

sys.path.insert(0, ".")
from dovetail.llm import filter_audit, grammar_repair, rank_array  # noqa: E402
from dovetail.llm.rank_merge import tokenizer_path  # noqa: E402


# ------------------------------------------------------------ filter audit

def audit_frame(spark, rows):
    """Documents with columns whose names the operator uses itself."""
    return spark.createDataFrame([(d, t, s, 1, "m", [1], 2) for d, t, s in rows],
                                 "doc_id bigint, text string, source string, n int, mask string, ws array<int>, least int")


def label_frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, quality int, toxic int, good string")


def test_audit_on_awkward_rows(spark, awkward):  # noqa: F811
    rng = random.Random(2)
    rows = [(d, t, rng.choice(["a", "b", None, ""])) for d, t in awkward]
    long = prose(250, rng)
    rows += [(100 + i, long, "a") for i in range(5)] + [(100, long, "b"), (None, long, "a"), (None, long, "a"), (103, long, "a")]
    rows += [(200, "A" + long.lower(), "c"), (201, ("x y z " * 100) + "$", "c"), (202, "A" + long.lower() + " ", "c")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, _, _ in rows] + [(100, 1, 1), (100, 0, None), (None, 1, 1)]
    got = rows_of(filter_audit.report(audit_frame(spark, rows), label_frame(spark, labels)), "part", "filter_order", "step", "kept",
                  "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert got == brute.filter_audit(rows, labels)
    assert len(got) == 600 * len({s or "" for _, _, s in rows})


def test_audit_of_a_hot_text(spark):
    """Half of all rows have one text: each but the smallest id is a copy."""
    rows = [(i, "same text" if i % 2 else f"own text {i}", "s") for i in range(2000)]
    got = filter_audit.combinations(audit_frame(spark, rows), label_frame(spark, []))
    n = {r["mask"]: r["n"] for r in got.collect()}
    assert sum(v for k, v in n.items() if k & filter_audit.BIT["E"]) == 999 and sum(n.values()) == 2000


def test_audit_of_empty_tables(spark):
    assert filter_audit.report(audit_frame(spark, []), label_frame(spark, [])).count() == 0
    assert filter_audit.report(audit_frame(spark, [(1, None, None)]), label_frame(spark, [])).count() == 600


# ------------------------------------------------------------ BPE

def brute_codes(rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    out = []
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        out.append((d, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(tok.decode(ids, skip_special_tokens=False))))
    return Counter(out)


@pytest.mark.parametrize("which", ["base", "awkward"])
def test_round_trip(spark, which, request):
    rows = request.getfixturevalue(which)
    assert rows_of(rank_array.round_trip(frame(spark, rows))) == brute_codes(rows)


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(4)
    chars = "ab \n\t'sA1é日\U0001f600  \x00<|>\r　\xa0�"
    rows = [(i, "".join(rng.choice(chars) for _ in range(rng.randrange(200)))) for i in range(300)]
    rows += [(900, "<|endoftext|><|endoftext|> <|endoftext|>x"), (901, "x" * 50_000), (902, "ab" * 20_000 + "c"),
             (903, "".join(rng.choice("abcdefgh") for _ in range(30_000))), (904, " " * 5000), (905, "\n" * 5000 + " a")]
    assert rows_of(rank_array.round_trip(frame(spark, rows))) == brute_codes(rows)


def test_scan_and_heap_agree():
    rng = random.Random(6)
    c = rank_array.Codec(tokenizer_path())
    for n in (2, 3, 10, 60, 250, 700):
        for letters in ("a", "ab", "abcde", "the quick", "éè"):
            w = [c.of_byte[b] for b in "".join(rng.choice(letters) for _ in range(n)).encode()]
            assert c._scan(list(w)) == c._heap(list(w))


def test_encode_gives_ids_and_text(spark, awkward):  # noqa: F811
    got = rank_array.encode(frame(spark, awkward)).collect()
    ids = brute.token_ids([t for _, t in awkward])
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in got) == Counter(
        (d, tuple(i), t or "") for (d, t), i in zip(awkward, ids))
    assert rank_array.round_trip(frame(spark, [])).count() == rank_array.encode(frame(spark, [])).count() == 0


# ------------------------------------------------------------ conversations

COLS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def talk(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, [2]) for r in rows],
                                 "conv_id bigint, turn bigint, role string, text string, `key` string, n int, pos array<int>")


def test_symbol_runs_against_all_edits():
    """Products of matrices, compressed or not, against trying every edit."""
    rng = random.Random(8)
    g = grammar_repair.Grammar(("su", "ua", "ĀA", "āā", "aS", "bd"))
    for _ in range(400):
        s = "".join(rng.choice("suaoSUAObd") for _ in range(rng.randrange(6)))
        found = ["t" if c.isupper() else c if c in "bd" else "" for c in s]
        want = brute.every_repair(s.lower(), found) or (0, "")
        assert grammar_repair.best(g.walk(grammar_repair.START, s)) == want == brute.repair(s.lower(), found)
        assert grammar_repair.best(grammar_repair.Grammar(()).walk(grammar_repair.START, s)) == want


def test_long_runs_against_states():
    rng = random.Random(9)
    pairs = ("ua", "ĀĀ", "UA", "āĂ", "uA")
    g = grammar_repair.Grammar(pairs)
    for n in (50, 3000):
        s = "".join(rng.choices("suaoSUAObd", [1, 8, 8, 1, 0, 2, 2, 0, 1, 1], k=n))
        found = ["t" if c.isupper() else c if c in "bd" else "" for c in s]
        assert grammar_repair.best(g.walk(grammar_repair.START, s)) == brute.repair(s.lower(), found)


def conversation_cases():
    rng = random.Random(10)
    text = lambda: rng.choice([None, "", "  \n", "Yes.", "No", "Ok!\n", "why?  ", "one. two", "é", "Yes."])
    role = lambda i: rng.choice(["user", "assistant"][i % 2:] + ["user", "assistant", "system", None, "", "unknown", "User"])
    rows = []
    for c in range(60):
        for i in range(rng.randrange(1, 9)):
            rows.append((c if c != 7 else None, rng.choice([i, i, i + 1, None, -i]), role(i), text()))
    rows += rng.sample(rows, 40)  # repeated rows
    rows += [(1000, i, ["user", "assistant"][i % 2], f"turn {i}.") for i in range(300)]
    rows += [(1001, i, "user", "the same") for i in range(200)]
    rows += [(1002, 5, "user", "x" * 100_000 + ".")]
    return rows


@pytest.mark.parametrize("most", [3, 4096])
def test_conversations(spark, most):
    rows = conversation_cases()
    got = rows_of(grammar_repair.report(talk(spark, rows), most), *COLS)
    assert got == Counter(brute.conversations(rows))


def test_given_conversations(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()]
    assert rows_of(grammar_repair.report(df), *COLS) == Counter(brute.conversations(rows))


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 3, "user", "  "), (2, 0, "user", "Hi.")]
    made, out = grammar_repair.repair(grammar_repair.conversation_rows(talk(spark, rows)))
    assert {r["conv_id"]: (r["audit"], r["cost"]) for r in made.collect()} == {1: ("KIKKDI", 10), 2: ("KI", 3)}
    got = sorted((r["conv_id"], r["pos"], r["role"], r["text"]) for r in out.collect())
    assert got == [(1, 0, "system", "Be kind."), (1, 1, "user", ""), (1, 2, "assistant", "Hello."), (1, 3, "user", "Hi."), (1, 4, "assistant", ""),
                   (2, 0, "user", "Hi."), (2, 1, "assistant", "")]


def test_no_conversations(spark):
    assert grammar_repair.report(talk(spark, [])).count() == 0


def test_learning_takes_the_most_frequent_pairs(spark):
    seqs = spark.createDataFrame([("uaua",), ("suaua",), ("uauaua",), ("ooo",)], "symbols string")
    pairs = grammar_repair.learn(seqs, rounds=3, each=2)
    assert pairs[0] == "ua" and grammar_repair.Grammar(pairs).compress("uauauaua") != "uauauaua"
    assert grammar_repair.learn(seqs.limit(0)) == ()
