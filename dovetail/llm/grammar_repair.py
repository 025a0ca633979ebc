"""Conversation repair by dynamic programming over a grammar-compressed corpus.

A conversation is a sequence of symbols, one per row in order of turn: the
initial of its role and its fault. A repair keeps, reroles or deletes each row
and inserts empty ones so that the roles read ``(s?(ua)+)?``. Four states say
how far a repaired conversation has come (nothing, s, u, a). What a symbol can
do is a 4 x 4 matrix over (min, +): from a state to a state, the least cost and,
among repairs of that cost, the least audit (string of edits). A sequence's
matrix is the product of its symbols'.

Most sequences are made of the same short runs. Re-Pair finds them: round by
round Spark counts the adjacent pairs of all distinct sequences, and the most
frequent ones become new symbols. Each rule's matrix is the product of its two
halves', made once, bottom-up, and shared by all conversations; an audit is a
rope of the halves' audits, laid out flat only for the answer.

Ties are exact without comparing ropes: audits that take the same rows end in
the last row's edit and hold one such letter per row, so none is a prefix of
another, and which of two is smaller is settled by the earlier factor. Each row
of a matrix carries the order of its audits, and a product computes the order
of its own from those of its factors.

Scale: a row becomes some 40 bytes (conversation, turn, MD5 of role and text,
symbol). Rows are sorted across tasks by (conversation, turn), so a
conversation of any length is cut into pieces of at most ``PIECE`` rows that
many tasks make; equal rows and equal sequences are combined before they move.
Only pieces meet per conversation, as a stream in order. Texts move twice: to
their edits, and in repaired order to the task that hashes their conversation
as a stream (a digest is one sequence of bytes; nothing is held but its state).

Defined cases: null role and text are one space (no initial fits, blank); null
turns come first; rows of one turn go by the MD5 of role and text; a null
conv_id is a conversation; a conversation without rows has zeros, an empty
audit and the hash of the empty string; an initial is the role's first
character, so any role that starts with u counts as u; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dovetail.llm.common import core, materialise

PIECE = 4096
ROUNDS = 6
RULES_A_ROUND = 16
DELETE, CHANGE, INSERT, TRUNCATED = 4, 3, 3, 3
#: States: nothing yet, s, u, a. What an inserted or reroled row leads to.
NOTHING, S, U, A = range(4)
NEXT = {NOTHING: U, S: U, U: A, A: U}
KEEPS = {("s", NOTHING): S, ("u", NOTHING): U, ("u", S): U, ("a", U): A, ("u", A): U}
#: Cost of the inserts that end a conversation in this state.
ENDING = {NOTHING: 0, S: 2, U: 1, A: 0}
LEGAL = {"su", "ua", "au"}
BLANK, DUPLICATE = "b", "d"
NAME = {U: "user", A: "assistant"}


# ------------------------------------------------------------ matrices
# A row: for each state None or (cost, order among the row's audits, rope);
# a rope: a string or a pair of ropes.

def _ranked(entries: dict) -> tuple:
    """entries: state -> (cost, sortable, rope)."""
    order = {j: i for i, j in enumerate(sorted(entries, key=lambda j: entries[j][1]))}
    return tuple((entries[j][0], order[j], entries[j][2]) if j in entries else None for j in range(4))


def symbol_matrix(symbol: str) -> tuple:
    """Inserts in front of one row, then its edit."""
    out = []
    for start in range(4):
        best: dict = {}
        state, front = start, ""
        for _ in range(3):  # more inserts come back to a state at a higher cost
            edits = [(state, DELETE, "D")]
            if symbol not in (BLANK, DUPLICATE):
                extra = TRUNCATED if symbol.isupper() else 0
                edits.append((NEXT[state], CHANGE + extra, "R"))
                if (symbol.lower(), state) in KEEPS:
                    edits.append((KEEPS[symbol.lower(), state], extra, "K"))
            for end, cost, letter in edits:
                new = (cost + INSERT * len(front), front + letter)
                if end not in best or new < best[end]:
                    best[end] = new
            state, front = NEXT[state], front + "I"
        out.append(_ranked({j: (c, audit, audit) for j, (c, audit) in best.items()}))
    return tuple(out)


def times(row: tuple, matrix: tuple) -> tuple:
    """A row times a matrix."""
    entries = {}
    for j in range(4):
        found = [(a[0] + m[j][0], a[1], m[j][1], k) for k, (a, m) in enumerate(zip(row, matrix)) if a and m[j]]
        if found:
            cost, rank, inner, k = min(found)
            entries[j] = (cost, (rank, inner), (row[k][2], matrix[k][j][2]))
    return _ranked(entries)


START = ((0, 0, ""), None, None, None)


def flat(rope) -> str:
    out, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += (x[1], x[0])
    return "".join(out)


class Grammar:
    """Pairs of symbols, each a new symbol, in the order they were made."""

    def __init__(self, pairs: tuple[str, ...]):
        self.pairs = [(p, chr(0x100 + i)) for i, p in enumerate(pairs)]
        self.matrix = {c: symbol_matrix(c) for c in "suaoSUAO" + BLANK + DUPLICATE}
        for pair, new in self.pairs:
            left, right = self.matrix[pair[0]], self.matrix[pair[1]]
            self.matrix[new] = tuple(times(row, right) for row in left)

    def compress(self, symbols: str) -> str:
        for pair, new in self.pairs:
            symbols = symbols.replace(pair, new)
        return symbols

    def walk(self, row: tuple, symbols: str) -> tuple:
        for c in self.compress(symbols):
            row = times(row, self.matrix[c])
        return row


@lru_cache(maxsize=2)
def grammar(pairs: tuple[str, ...]) -> Grammar:
    return Grammar(pairs)


def best(row: tuple) -> tuple[int, str]:
    """Least cost and audit of whole conversations that end after ``row``."""
    cost, _, k = min((x[0] + INSERT * ENDING[k], x[1], k) for k, x in enumerate(row) if x)
    return cost, flat(row[k][2]) + "I" * ENDING[k]


def learn(sequences: DataFrame, rounds: int = ROUNDS, each: int = RULES_A_ROUND) -> tuple[str, ...]:
    """Re-Pair over the column ``symbols``: the pairs that became rules, the
    most frequent first. A round takes up to ``each`` pairs that share no
    symbol, so none touches another's places. The driver sees that many rows."""
    pairs: tuple[str, ...] = ()
    for _ in range(rounds):
        def count(batches, pairs=pairs):
            import pyarrow as pa
            g, n = grammar(pairs), Counter()
            for batch in batches:
                for s in batch.column(0).to_pylist():
                    s = g.compress(s)
                    n.update(map("".join, zip(s, s[1:])))
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], names=["pair", "n"])

        counts = sequences.select("symbols").mapInArrow(count, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counts.where("n > 1").orderBy(F.desc("n"), "pair").limit(4 * each).collect()
        used: set = set()
        new = []
        for r in top:
            if not used & set(r["pair"]) and len(new) < each:
                new.append(r["pair"])
                used |= set(r["pair"])
        if not new:
            break
        pairs += tuple(new)
    return pairs


# ------------------------------------------------------------ Spark jobs

def conversation_rows(conversations: DataFrame) -> DataFrame:
    d = core(conversations, ("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string"))
    return d.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})


def damage(rows: DataFrame) -> DataFrame:
    """Rows with made faults, by CRC-32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it user."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    d = rows.withColumn("kind", kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return d.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _key() -> Column:
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))


def symbols(rows: DataFrame) -> DataFrame:
    """conv_id, turn, key, init (of the role), symbol (of the first of n equal rows), n."""
    init = F.substring("role", 1, 1)
    letter = F.when(init.isin("s", "u", "a"), init).otherwise("o")
    closed = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    symbol = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(closed, letter).otherwise(F.upper(letter))
    slim = rows.select("conv_id", "turn", _key().alias("key"), letter.alias("init"), symbol.alias("symbol"))
    slim = slim.groupBy("conv_id", "turn", "key", "init", "symbol").agg(F.count("*").alias("n"))
    seen = slim.groupBy("conv_id", "key").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns")).where(
        "turns > 1").select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "first")
    again = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn")) & (F.col("symbol") != BLANK)
    return slim.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left").select(
        "conv_id", "turn", "key", "init", F.when(again, DUPLICATE).otherwise(F.col("symbol")).alias("symbol"), "n")


_PIECE = ("conv_id bigint, ord bigint, symbols string, keys array<binary>, blank bigint, duplicate bigint, truncated bigint, "
          "illegal bigint, head string, tail string, low bigint, high bigint, turns bigint")


def pieces(slim: DataFrame, most: int = PIECE) -> DataFrame:
    """Runs of at most ``most`` rows of one conversation, in order of ``ord``.
    keys: of the rows that need not go. low, high, turns: of those known."""

    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        ord_ = TaskContext.get().partitionId() << 32
        schema = pa.schema([("conv_id", pa.int64()), ("ord", pa.int64()), ("symbols", pa.string()), ("keys", pa.list_(pa.binary())),
                            *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")], ("head", pa.string()),
                            ("tail", pa.string()), *[(c, pa.int64()) for c in ("low", "high", "turns")]])
        out, now, syms, inits, keys, turns = [], None, [], [], [], []

        def close():
            nonlocal ord_
            if syms:
                known = [t for t in dict.fromkeys(turns) if t is not None]
                out.append((now, ord_, "".join(syms), list(keys), syms.count(BLANK), syms.count(DUPLICATE), sum(map(str.isupper, syms)),
                            sum(a + b not in LEGAL for a, b in zip(inits, inits[1:])), inits[0], inits[-1],
                            min(known, default=None), max(known, default=None), len(known)))
                ord_ += 1
                for x in (syms, inits, keys, turns):
                    x.clear()

        def batch_out():
            b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return b

        for batch in batches:
            for conv, turn, key, init, symbol, n in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != now:
                    close()
                    now = conv
                for i in range(n):
                    if len(syms) >= most:
                        close()
                    syms.append(symbol if i == 0 or symbol == BLANK else DUPLICATE)
                    inits.append(init)
                    turns.append(turn)
                    if syms[-1] not in (BLANK, DUPLICATE):
                        keys.append(key)
            if len(out) >= 1024:
                yield batch_out()
        close()
        if out:
            yield batch_out()

    dealt = slim.repartitionByRange("conv_id", "turn", "key").sortWithinPartitions("conv_id", "turn", "key")
    return dealt.mapInArrow(cut, _PIECE)


_PLAN = ("conv_id bigint, ord bigint, audit string, state int, pos bigint, cost bigint, blank bigint, duplicate bigint, "
         "truncated bigint, illegal bigint, gaps bigint")


def plans(cut: DataFrame, pairs: tuple[str, ...]) -> DataFrame:
    """For every conversation a row (ord null) with its whole audit, cost and
    counts, and for every piece one with its part of the audit, the state and
    the number of repaired rows before it."""

    def run(batches):
        import pyarrow as pa
        schema = pa.schema([("conv_id", pa.int64()), ("ord", pa.int64()), ("audit", pa.string()), ("state", pa.int32()),
                            *[(c, pa.int64()) for c in ("pos", "cost", "blank", "duplicate", "truncated", "illegal", "gaps")]])
        g, known, out, held = grammar(pairs), {}, [], []

        def solve(seqs):
            if len(seqs) == 1 and seqs[0] in known:
                return known[seqs[0]]
            row = START
            for s in seqs:
                row = g.walk(row, s)
            found = best(row)
            if len(seqs) == 1:
                if len(known) > 100_000:
                    known.clear()
                known[seqs[0]] = found
            return found

        def close():
            if not held:
                return
            conv = held[0]["conv_id"]
            cost, audit = solve([p["symbols"] for p in held])
            total = {c: sum(p[c] for p in held) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
            for p, q in zip(held, held[1:]):
                total["illegal"] += p["tail"] + q["head"] not in LEGAL
                total["turns"] -= p["high"] is not None and p["high"] == q["low"]
            low = [p["low"] for p in held if p["low"] is not None]
            gaps = max(p["high"] for p in held if p["high"] is not None) - min(low) + 1 - total["turns"] if low else 0
            out.append((conv, None, audit, None, None, cost, total["blank"], total["duplicate"], total["truncated"], total["illegal"], gaps))
            at = pos = 0
            has_s = False
            for i, p in enumerate(held):
                end, rows = at, len(p["symbols"])
                while rows:
                    rows -= audit[end] != "I"
                    end += 1
                part = audit[at:] if i + 1 == len(held) else audit[at:end]
                state = NOTHING if pos == 0 else S if has_s and pos == 1 else A if (pos - has_s) % 2 == 0 else U
                out.append((conv, p["ord"], part, state, pos, *[None] * 6))
                if pos == 0:
                    has_s = _starts_with_s(p["symbols"], part)
                pos += len(part) - part.count("D")
                at = end
            held.clear()

        def batch_out():
            b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return b

        for batch in batches:
            for p in batch.to_pylist():
                if held and held[0]["conv_id"] != p["conv_id"]:
                    close()
                held.append(p)
            if len(out) >= 1024:
                yield batch_out()
        close()
        if out:
            yield batch_out()

    slim = cut.drop("keys").repartition("conv_id").sortWithinPartitions("conv_id", "ord")
    return slim.mapInArrow(run, _PLAN)


def _starts_with_s(syms: str, audit: str) -> bool:
    """Whether the first repaired row is one that was kept with the initial s."""
    rows = iter(syms)
    for letter in audit:
        symbol = next(rows) if letter != "I" else ""
        if letter != "D":
            return letter == "K" and symbol in ("s", "S")
    return False


def edits(cut: DataFrame, plan: DataFrame) -> DataFrame:
    """conv_id, pos, key (null: inserted), role (null: as it was) of every repaired row."""

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                state, pos, keys, rows = p["state"], p["pos"], iter(p["keys"]), iter(p["symbols"])
                for letter in p["audit"]:
                    symbol = next(rows) if letter != "I" else ""
                    key = next(keys) if symbol and symbol not in (BLANK, DUPLICATE) else None
                    if letter == "D":
                        continue
                    state = KEEPS[symbol.lower(), state] if letter == "K" else NEXT[state]
                    out.append((p["conv_id"], pos, key, None if letter == "K" else NAME[state]))
                    pos += 1
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.string()))],
                                             names=["conv_id", "pos", "key", "role"])

    both = cut.select("conv_id", "ord", "symbols", "keys").join(
        plan.where("ord is not null").select("ord", "audit", "state", "pos"), "ord")
    return both.mapInArrow(run, "conv_id bigint, pos bigint, key binary, role string")


def apply_edits(rows: DataFrame, made: DataFrame) -> DataFrame:
    """conv_id, pos, role, text of all repaired rows; equal rows of one
    conversation may come several times with one pos (only one is kept)."""
    placed = made.where("key is not null").select(F.col("conv_id").alias("c"), "pos", F.col("key").alias("k"), F.col("role").alias("r"))
    texts = rows.withColumn("key", _key())
    kept = texts.join(placed, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k"))).select(
        "conv_id", "pos", F.coalesce("r", "role").alias("role"), "text")
    new = made.where("key is null").select("conv_id", "pos", "role", F.lit("").alias("text"))
    return kept.unionByName(new)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the lines ``role:text`` in order."""

    def run(batches):
        import pyarrow as pa
        now, last, h, started, out = None, None, None, False, []
        for batch in batches:
            for conv, pos, line in zip(*(c.to_pylist() for c in batch.columns)):
                if not started or conv != now:
                    if started:
                        out.append((now, h.hexdigest()))
                    now, last, h, started = conv, None, hashlib.sha256(), True
                if pos != last:
                    h.update((line if last is None else "\n" + line).encode("utf-8"))
                    last = pos
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string()))],
                                                 names=["conv_id", "repaired_sha256"])
                out = []
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([h.hexdigest()], pa.string())],
                                             names=["conv_id", "repaired_sha256"])

    lines = repaired.select("conv_id", "pos", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(run, "conv_id bigint, repaired_sha256 string")


def repair(rows: DataFrame, most: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """(conversations, repaired rows) of rows as from :func:`conversation_rows`."""
    cut = materialise(pieces(symbols(rows), most), "repair-pieces")
    pairs = learn(materialise(cut.select("symbols").distinct(), "repair-sequences"))
    plan = materialise(plans(cut, pairs), "repair-plans")
    return plan.where("ord is null").drop("ord", "state", "pos"), apply_edits(rows, materialise(edits(cut, plan), "repair-edits"))


def report(conversations: DataFrame, most: int = PIECE) -> DataFrame:
    """Every conversation, damaged and repaired."""
    every = conversation_rows(conversations)
    made, repaired = repair(damage(every), most)
    ids = every.select("conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    for right in (made, digests(repaired)):
        right = right.withColumnRenamed("conv_id", "c")
        ids = ids.join(right, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    return ids.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
