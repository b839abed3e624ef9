"""Repair of conversation structure: grammar-compressed dynamic programming.

The rows of a conversation, in order, become a string with one symbol a row:
its role's initial and its fault. The cheapest edits that turn the roles into
an optional system row and one or more (user, assistant) exchanges, or into
nothing, are a shortest path through four states:

    0 nothing yet, 1 after the system row, 2 after a user, 3 after an assistant

A symbol is a min-plus transfer matrix over the states; an entry holds the
least cost and, as a rope, the ASCII-least edits of that cost. Re-Pair replaces
frequent pairs of neighbouring symbols, counted over the strings of all
conversations, by new symbols; each rule has one matrix, the product of its
two parts', made bottom-up once and shared by all conversations. A
conversation is then a short string of rules: costs to the end are summed
backwards, and the edits are chosen forwards. (Edits of one cost for the same
rows are never proper prefixes of each other, so least parts give least wholes.)

Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (the only one for blank
and repeated rows), Insert an empty user or assistant row 5; a truncated row
that stays costs 5 more.

Rows are ordered by (turn, role, hash of the text), null turns first. The
order comes from a range partitioning of small rows without texts, so a very
long conversation is split over tasks; copies of a row are counted before
that. A conversation's string and edits hold one byte a row, as its result does.

Defined results: null roles and texts count as one space; null conversation
ids are one conversation; repeated rows are duplicates of each other; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import col, materialize

BLANKS = " \t\n\v\f\r"
ROUNDS = 12
#: Rules made from one count of the pairs.
PER_ROUND = 64
#: Rows that a rule spans at most.
RULE_ROWS = 4096
#: Characters of repaired conversations that a task remembers.
MEMORY = 1 << 22
FIRST_RULE = 0xE000

STATES = 4
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NEXT_ROLE = {"u": "user", "a": "assistant"}
#: Row symbols: initials (o: any other), upper case if truncated; x: must go.
SYMBOLS = "suaoSUAOx"

Rope = str | tuple
Matrix = list[list[tuple[int, Rope] | None]]


def flat(rope: Rope) -> str:
    """The edits of a rope."""
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            out.append(r)
        else:
            todo += (r[1], r[0])
    return "".join(out)


def _least(ways: list[tuple[int, Rope]]) -> tuple[int, Rope] | None:
    if not ways:
        return None
    cost = min(c for c, _ in ways)
    ways = [w for w in ways if w[0] == cost]
    return ways[0] if len(ways) == 1 else min(ways, key=lambda w: flat(w[1]))


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product."""
    return [[_least([(x[0] + y[0], (x[1], y[1])) for k in range(STATES) if (x := a[i][k]) and (y := b[k][j])])
             for j in range(STATES)] for i in range(STATES)]


def _insertions() -> Matrix:
    """Any number of inserted rows, none included."""
    best: Matrix = [[(0, "") if i == j else None for j in range(STATES)] for i in range(STATES)]
    step: Matrix = [[None] * STATES for _ in range(STATES)]
    for (i, letter), j in MOVES.items():
        if letter in NEXT_ROLE:
            step[i][j] = (INSERT, "I")
    for _ in range(STATES):
        more = times(best, step)
        best = [[_least([w for w in (best[i][j], more[i][j]) if w]) for j in range(STATES)] for i in range(STATES)]
    return best


INSERTIONS = _insertions()


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions, then the edit of one row."""
    ways: list[list[list]] = [[[] for _ in range(STATES)] for _ in range(STATES)]
    extra = TRUNCATED if symbol.isupper() else 0
    for i in range(STATES):
        ways[i][i].append((DELETE, "D"))
        if symbol == "x":
            continue
        if (j := MOVES.get((i, symbol.lower()))) is not None:
            ways[i][j].append((KEEP + extra, "K"))
        for letter in NEXT_ROLE:
            if (j := MOVES.get((i, letter))) is not None:
                ways[i][j].append((REROLE + extra, "R"))
    return times(INSERTIONS, [[_least(w) for w in row] for row in ways])


class Grammar:
    """Rules of pairs of symbols and the matrices of all symbols."""

    def __init__(self) -> None:
        self.rules: list[tuple[str, str]] = []
        self.matrix = {s: symbol_matrix(s) for s in SYMBOLS}
        self.rows = dict.fromkeys(SYMBOLS, 1)

    def add(self, pair: str) -> None:
        symbol = chr(FIRST_RULE + len(self.rules))
        self.rules.append((pair, symbol))
        self.matrix[symbol] = times(self.matrix[pair[0]], self.matrix[pair[1]])
        self.rows[symbol] = sum(map(self.rows.get, pair))

    def extend(self, pairs: list[tuple[str, int]]) -> bool:
        """Rules for the most frequent pairs that share no symbol."""
        used: set[str] = set()
        before = len(self.rules)
        for pair, n in pairs:
            if n > 1 and not used & set(pair) and sum(map(self.rows.get, pair)) <= RULE_ROWS:
                used |= set(pair)
                self.add(pair)
                if len(self.rules) - before == PER_ROUND:
                    break
        return len(self.rules) > before


def compress(text: str, rules: list[tuple[str, str]]) -> str:
    for pair, symbol in rules:
        text = text.replace(pair, symbol)
    return text


def cheapest(symbols: str, matrix: dict[str, Matrix]) -> tuple[int, str]:
    """(cost, edits) of a conversation's symbols."""
    end = [min((c[0], c[1]) for j in ENDS if (c := INSERTIONS[i][j])) for i in range(STATES)]
    togo = [[c for c, _ in end]]
    for s in reversed(symbols):
        m, after = matrix[s], togo[-1]
        togo.append([min(w[0] + after[j] for j in range(STATES) if (w := m[i][j])) for i in range(STATES)])
    state, edits = 0, []
    for s, before, after in zip(symbols, togo[::-1], togo[-2::-1]):
        m = matrix[s]
        ways = [(w[1], j) for j in range(STATES) if (w := m[state][j]) and w[0] + after[j] == before[state]]
        rope, state = ways[0] if len(ways) == 1 else min((flat(r), j) for r, j in ways)
        edits.append(flat(rope))
    edits.append(flat(end[state][1]))
    return togo[-1][0], "".join(edits)


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(columns, types.values())], list(types))


def _pair_counts(rules: list[tuple[str, str]]):
    types = {"pair": pa.string(), "n": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: Counter = Counter()
            strings = compress("\n".join(b.column("symbols").to_pylist()), rules).split("\n")
            for s, n in zip(strings, b.column("n").to_pylist()):
                for pair, times_ in Counter(x + y for x, y in zip(s, s[1:])).items():
                    found[pair] += times_ * n
            yield _batch(list(found.items()), types)
    return run


def grammar(strings: DataFrame) -> Grammar:
    """Re-Pair over the strings of all conversations (symbols, n), pairs
    counted by Spark; at most ROUNDS * PER_ROUND rules reach the driver."""
    made = Grammar()
    for _ in range(ROUNDS):
        counts = strings.mapInArrow(_pair_counts(made.rules), "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counts.where("n > 1").orderBy(F.desc("n"), "pair").limit(4 * PER_ROUND).collect()
        if not made.extend([(r.pair, r.n) for r in top]):
            break
    return made


def _solve(made: Grammar):
    rules, matrix = made.rules, made.matrix
    types = {"ckey": pa.string(), "cost": pa.int64(), "audit": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, str]] = {}
        held = 0
        for b in batches:
            rows = []
            for key, symbols in zip(b.column("ckey").to_pylist(), b.column("symbols").to_pylist()):
                answer = known.get(symbols)
                if answer is None:
                    if held > MEMORY:
                        known, held = {}, 0
                    answer = known[symbols] = cheapest(compress(symbols, rules), matrix)
                    held += 2 * len(symbols) + 200
                rows.append((key, *answer))
            yield _batch(rows, types)
    return run


_PIECE = {"ckey": pa.string(), "known": pa.int32(), "turn": pa.int64(), "role": pa.string(), "hash": pa.binary(),
          "first": pa.string(), "last": pa.string(), "illegal": pa.int64(), "symbols": pa.string()}
_LEGAL = {"su", "ua", "au"}


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of one conversation, as strings of symbols."""
    at = None
    for b in batches:
        out = []
        for key, known, turn, role, digest, letter, symbol, n in zip(*(b.column(c).to_pylist() for c in (
                "ckey", "known", "turn", "role", "hash", "letter", "symbol", "n"))):
            if key != at:
                if at is not None:
                    out.append((*head, last, illegal, "".join(symbols)))
                at, head, last, illegal, symbols = key, (key, known, turn, role, digest, letter), None, 0, []
            if last is not None and last + letter not in _LEGAL:
                illegal += 1
            illegal += n - 1  # no role follows itself
            last = letter
            symbols.append(symbol + "x" * (n - 1))
        yield _batch(out, _PIECE)
    if at is not None:
        yield _batch([(*head, last, illegal, "".join(symbols))], _PIECE)


def _ddl(types: dict[str, pa.DataType]) -> str:
    names = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{c} {names[t]}" for c, t in types.items())


def ordered(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(ckey, known, turn, role, hash, text): the rows with the columns that
    order them."""
    of = lambda c: F.coalesce(col(conversations, c).cast("string"), F.lit(" "))
    when = col(conversations, turn).cast("long")
    return conversations.select(
        F.coalesce(F.concat(F.lit("="), col(conversations, conv_id).cast("string")), F.lit("")).alias("ckey"),
        when.isNotNull().cast("int").alias("known"), F.coalesce(when, F.lit(0)).alias("turn"), of(role).alias("role"),
        F.unhex(F.md5(of(text).cast("binary"))).alias("hash"), of(text).alias("text"))


def _flagged(rows: DataFrame) -> DataFrame:
    """Distinct rows, without texts: their number, fault and symbol."""
    full = F.rtrim("text", F.lit(BLANKS))
    letter = F.substring("role", 1, 1)
    seen = rows.select("ckey", "known", "turn", "role", "hash", (full == "").alias("empty"),
                       F.when(F.right(full, F.lit(1)).isin(".", "!", "?"), False).otherwise(True).alias("open"),
                       F.when(letter.isin("s", "u", "a"), letter).otherwise("o").alias("letter"))
    place = ["ckey", "role", "hash", "known", "turn"]
    seen = materialize(seen.groupBy(*place).agg(
        F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("empty", "open", "letter"))), "conversation-rows")
    # The first row of each (conversation, role, text), found by its whole place: no key of that join repeats.
    first = seen.groupBy("ckey", "role", "hash").agg(F.min(F.struct("known", "turn")).alias("at")) \
        .select("ckey", "role", "hash", "at.known", "at.turn", F.lit(True).alias("new"))
    rows = seen.join(first, place, "left").withColumn("new", F.coalesce("new", F.lit(False)))
    symbol = F.when(F.col("empty") | ~F.col("new"), "x").when(F.col("open"), F.upper("letter")).otherwise(F.col("letter"))
    one = F.col("new").cast("long")
    return materialize(rows.select(
        *place, "letter", "n", symbol.alias("symbol"), F.when(F.col("empty"), F.col("n")).otherwise(0).alias("blank"),
        F.when(F.col("empty"), 0).otherwise(F.col("n") - one).alias("duplicate"),
        F.when(F.col("empty") | ~F.col("open"), 0).otherwise(one).alias("truncated")), "conversation-faults")


def repair_plans(rows: DataFrame) -> DataFrame:
    """(ckey, gaps, blank, duplicate, truncated, illegal, cost, audit) of the
    conversations in ``rows`` (see ``ordered``)."""
    flagged = _flagged(rows)
    faults = ["blank", "duplicate", "truncated"]
    turns = flagged.groupBy("ckey", "known", "turn").agg(*(F.sum(c).alias(c) for c in faults))
    given = F.when(F.col("known") == 1, F.col("turn"))
    counts = turns.groupBy("ckey").agg(
        F.coalesce(F.max(given) - F.min(given) + 1 - F.count(given), F.lit(0)).alias("gaps"), *(F.sum(c).alias(c) for c in faults))
    tasks = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["ckey", "known", "turn", "role", "hash"]
    pieces = flagged.select(*order, "letter", "symbol", "n").repartitionByRange(tasks, *order).sortWithinPartitions(*order) \
        .mapInArrow(_pieces, _ddl(_PIECE))
    whole = pieces.groupBy("ckey").agg(F.sort_array(F.collect_list(F.struct(*(c for c in _PIECE if c != "ckey")))).alias("p"))
    border = "CASE WHEN a.last <> '' AND NOT concat(a.last, x.first) IN ('su', 'ua', 'au') THEN 1 ELSE 0 END"
    strings = materialize(whole.select(
        "ckey", F.expr("array_join(transform(p, x -> x.symbols), '')").alias("symbols"),
        F.expr(f"aggregate(p, struct('' AS last, 0L AS n), (a, x) -> struct(x.last AS last, a.n + x.illegal + {border} AS n)).n")
        .alias("illegal")), "conversation-strings")
    made = grammar(materialize(strings.groupBy("symbols").agg(F.count("*").alias("n")), "conversation-grammar"))
    solved = strings.select("ckey", "symbols").mapInArrow(_solve(made), "ckey string, cost long, audit string")
    return materialize(counts.join(strings.select("ckey", "illegal"), "ckey").join(solved, "ckey"), "conversation-plans")


_REPAIRED = {"ckey": pa.string(), "position": pa.int64(), "role": pa.string(), "text": pa.string()}


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of conversations, each behind its audit, turned into repaired ones."""
    key, audit, at, place, odd = None, "", 0, 0, 0

    def role_at() -> str:
        return "user" if (place - odd) % 2 == 0 else "assistant"

    def inserted() -> Iterator[tuple]:
        nonlocal at, place
        while at < len(audit) and audit[at] == "I":
            yield key, place, role_at(), ""
            at, place = at + 1, place + 1

    for b in batches:
        out: list[tuple] = []
        for ckey, head, role, text in zip(*(b.column(c).to_pylist() for c in ("ckey", "audit", "role", "text"))):
            if head is not None:
                out += inserted()
                key, audit, at, place, odd = ckey, head, 0, 0, (len(head) - head.count("D")) % 2
                continue
            out += inserted()
            edit, at = audit[at], at + 1
            if edit != "D":
                out.append((key, place, role if edit == "K" else role_at(), text))
                place += 1
        yield _batch(out, _REPAIRED)
    yield _batch(list(inserted()), _REPAIRED)


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(ckey, position, role, text): the conversations after their edits, a
    conversation's rows next to each other and in order."""
    heads = plans.select("ckey", "audit", F.lit(-1).alias("known"), F.lit(0).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.lit(None).cast("binary").alias("hash"), F.lit("").alias("text"))
    body = rows.select("ckey", F.lit(None).cast("string").alias("audit"), "known", "turn", "role", "hash", "text")
    tasks = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["ckey", "known", "turn", "role", "hash"]
    return heads.unionByName(body).repartition(tasks, "ckey").sortWithinPartitions(*order).mapInArrow(_apply, _ddl(_REPAIRED))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"ckey": pa.string(), "sha256": pa.string()}
    at, state = None, None
    for b in batches:
        out = []
        for key, role, text in zip(*(b.column(c).to_pylist() for c in ("ckey", "role", "text"))):
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            if key != at:
                if at is not None:
                    out.append((at, state.hexdigest()))
                at, state = key, hashlib.sha256(line)
            else:
                state.update(b"\n" + line)
        yield _batch(out, types)
    if at is not None:
        yield _batch([(at, state.hexdigest())], types)


def digests(rows: DataFrame) -> DataFrame:
    """(ckey, sha256) of repaired conversations as lines of ``role:text``. SHA-256
    is a chain, so a conversation passes through one task, as a stream."""
    return rows.mapInArrow(_digest, "ckey string, sha256 string")
