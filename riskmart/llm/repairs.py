"""Conversation structure repair: the cheapest edits that bring a conversation into the form ``(s?(ua)+)?`` of role initials.

Each edit is an edge of a DAG whose nodes are (rows read, place in the form). Its weight is one big integer: the high digits carry the
cost, and below them stands one octal digit per letter of the audit, the first letter highest, zeros after the last. Sums of weights along
a path thus spell (cost, audit), a shorter audit sorts before any that goes on, and the ordinary minimum of integers decides everything.

A conversation is never gathered as a whole: rows get their place by range partitioning, blocks of ``BLOCK`` consecutive rows are solved from each
node to each, and ``FAN`` neighbouring blocks at a time are put together until one is left. Between two nodes of one block no audit of least cost starts
another (inserts cost more than nothing), so block-wise minima are the minima of the whole. What one task holds of a conversation are
letters: its audit, which the result has as one value anyway. Texts are hashed as a sorted stream; a SHA-256 is sequential, so this step reads
a conversation in one task, batch by batch.

Defined cases: NULL conversations are one of their own; a NULL role or text is one blank, NULL turns come first; rows of one conversation and turn are ordered by
a digest of role and text; further columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import ranked
from riskmart.session import staged

BLOCK, FAN = 256, 64
SPACES = " \t\n\x0b\x0c\r"
#: Digits of the audit letters; zero is the padding.
DIGITS = str.maketrans("DIKR", "1234")
LETTERS = str.maketrans("1234", "DIKR")
BITS = 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: The place after a turn that is written anew, by the place before it.
TURN = (USER, USER, ASSISTANT, USER)
KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
LEGAL = {"su", "ua", "au"}
WAYS = "array<struct<begin:int,end:int,cost:long,audit:string>>"
PIECE = f"_conv string, _block long, blank long, duplicate long, truncated long, illegal long, first string, last string, n_turns long, first_turn long, last_turn long, ways {WAYS}"

Node = tuple[int, int] | None


def damaged(conversations: DataFrame) -> DataFrame:
    """(_conv, _turn, _role, _text) after the damage; ``_conv`` is a text that names NULL apart."""
    def blank(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text"))
    rows = conversations.select(conv_key("conv_id").alias("_conv"), F.col("turn").cast("long").alias("_turn"), blank("role").alias("_role"), blank("text").alias("_text"), kind.alias("_kind"))
    rows = rows.where("_kind != 0").withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select("_conv", "_turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("_role")).alias("_role"), text.alias("_text"))


def conv_key(c: str) -> Column:
    return F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(c).cast("string")))


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with their place in the conversation, a digest and what is wrong with each alone: '.' nothing, 'b' blank, 't' truncated."""
    bare = F.rtrim(F.col("_text"), F.lit(SPACES))
    fault = F.when(F.length(bare) == 0, "b").when(F.substring(bare, -1, 1).isin(".", "!", "?"), ".").otherwise("t")
    initial = F.substring("_role", 1, 1)
    digest = F.sha2(F.concat_ws(":", F.length("_role").cast("string"), "_role", "_text"), 256)
    rows = rows.withColumns({"_digest": digest, "_salt": F.monotonically_increasing_id(), "_fault": fault,
                             "_initial": F.when(initial.isin("s", "u", "a"), initial).otherwise("x")})
    return ranked(rows, ["_conv"], "_place", ["_turn", "_digest", "_salt"])  # equal rows are split by the salt


# --- paths of least weight -----------------------------------------------------------------------------------------

def _less(a: Node, b: Node) -> Node:
    return b if a is None or b is not None and b[0] < a[0] else a


def _with_inserts(nodes: list[Node], edge) -> list[Node]:
    """The nodes after any number of inserts; a third in a row would come back to a node already reached at less cost."""
    nodes = list(nodes)
    for _ in range(2):
        for at in range(4):
            if nodes[at]:
                nodes[TURN[at]] = _less(nodes[TURN[at]], edge(nodes[at], 5, 2))
    return nodes


def _edges(digits: int):
    def edge(node: Node, cost: int, digit: int) -> Node:
        weight, letters = node
        return weight + (cost << BITS * digits) + (digit << BITS * (digits - 1 - letters)), letters + 1

    return edge


def _spell(node: Node, digits: int) -> tuple[int, str]:
    audit = oct(node[0] & ((1 << BITS * digits) - 1))[2:].zfill(digits)[:node[1]] if node[1] else ""
    return node[0] >> BITS * digits, audit.translate(LETTERS)


def block_ways(codes: str, begins: Sequence[int]) -> list[tuple[int, int, int, str]]:
    """(begin, end, cost, audit) of the best edits of the rows in ``codes``, two characters each: initial and fault."""
    rows = list(zip(codes[::2], codes[1::2]))
    digits = len(rows) + (2 * len(rows) + 10) // 5 + 3  # deleting all and two inserts lead everywhere, so no more inserts pay
    edge, out = _edges(digits), []
    for begin in begins:
        nodes: list[Node] = [None] * 4
        nodes[begin] = (0, 0)
        for initial, fault in rows:
            before, nodes = _with_inserts(nodes, edge), [None] * 4
            more = 5 if fault == "t" else 0
            for at, node in enumerate(before):
                if node is None:
                    continue
                nodes[at] = _less(nodes[at], edge(node, 2, 1))
                if fault in ".t":
                    if (kept := KEPT.get((initial, at))) is not None:
                        nodes[kept] = _less(nodes[kept], edge(node, more, 3))
                    nodes[TURN[at]] = _less(nodes[TURN[at]], edge(node, 1 + more, 4))
        out += [(begin, end, *_spell(node, digits)) for end, node in enumerate(nodes) if node]
    return out


def joined_ways(pieces: Sequence[Sequence[tuple[int, int, int, str]]]) -> list[tuple[int, int, int, str]]:
    """The ways through consecutive pieces: edges are whole ways here, the weights are the same."""
    digits, out = sum(max(len(w[3]) for w in ways) for ways in pieces), []
    worded = [[(b, e, c, int(a.translate(DIGITS) or "0", 8), len(a)) for b, e, c, a in ways] for ways in pieces]
    for begin in sorted({w[0] for w in pieces[0]}):
        nodes: list[Node] = [None] * 4
        nodes[begin] = (0, 0)
        for ways in worded:
            before, nodes = nodes, [None] * 4
            for b, e, cost, word, n in ways:
                if before[b]:
                    weight, letters = before[b]
                    to = weight + (cost << BITS * digits) + (word << BITS * (digits - letters - n)), letters + n
                    nodes[e] = _less(nodes[e], to)
        out += [(begin, end, *_spell(node, digits)) for end, node in enumerate(nodes) if node]
    return out


def whole_way(ways: Sequence[tuple[int, int, int, str]]) -> tuple[int, str]:
    """(cost, audit) of the best way from the start to an end of the form, inserts after the last row included."""
    digits = max(len(w[3]) for w in ways) + 3
    edge, nodes = _edges(digits), [None] * 4
    for begin, end, cost, audit in ways:
        if begin == START:
            nodes[end] = ((cost << BITS * digits) + (int(audit.translate(DIGITS) or "0", 8) << BITS * (digits - len(audit))), len(audit))
    nodes = _with_inserts(nodes, edge)
    return _spell(_less(nodes[START], nodes[ASSISTANT]), digits)


# --- Arrow steps ---------------------------------------------------------------------------------------------------

def _step(df: DataFrame, schema: str, of, rows_each: int = 64) -> DataFrame:
    """``df.mapInArrow`` with ``of``: a few rows as dictionaries in, some (an iterable) out, so that a task holds a few rows as objects."""
    import pyspark.sql.types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, rows_each):
                rows: list = []
                for row in of(batch.slice(i, rows_each).to_pylist()):
                    rows.append(row)
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, arrow)

    return df.mapInArrow(run, schema)


def _ways(ways: Sequence[tuple[int, int, int, str]]) -> list[dict]:
    return [dict(zip(("begin", "end", "cost", "audit"), w)) for w in ways]


def _solve(rows: list[dict]) -> Iterator[dict]:
    for r in rows:
        codes = r.pop("codes")
        initials = codes[::2]
        wrong = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        begins = (START,) if r["_block"] == 0 else range(4)
        yield r | {"illegal": wrong, "first": initials[:1], "last": initials[-1:], "ways": _ways(block_ways(codes, begins))}


def _join(rows: list[dict]) -> Iterator[dict]:
    for r in rows:
        pieces = sorted(r["pieces"], key=lambda p: p["_block"])
        out = {k: sum(p[k] for p in pieces) for k in ("blank", "duplicate", "truncated", "illegal", "n_turns")}
        out["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(pieces, pieces[1:]))
        turned = [p for p in pieces if p["n_turns"]]
        out["n_turns"] -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(turned, turned[1:]))
        ways = joined_ways([[tuple(w.values()) for w in p["ways"]] for p in pieces])
        yield out | {"_conv": r["_conv"], "_block": r["_block"], "first": pieces[0]["first"], "last": pieces[-1]["last"], "ways": _ways(ways),
                     "first_turn": turned[0]["first_turn"] if turned else None, "last_turn": turned[-1]["last_turn"] if turned else None}


def _finish(rows: list[dict]) -> Iterator[dict]:
    for r in rows:
        cost, audit = whole_way([tuple(w.values()) for w in r["ways"]])
        gaps = r["last_turn"] - r["first_turn"] + 1 - r["n_turns"] if r["n_turns"] else 0
        yield {k: r[k] for k in ("_conv", "blank", "duplicate", "truncated", "illegal")} | {"gaps": gaps, "cost": cost, "audit": audit}


def _spread(rows: list[dict]) -> Iterator[dict]:
    """One row per edited row: the verb, the role it gets, and the inserted turns before it (and, at the last one, after it)."""
    for r in rows:
        # an odd number of turns begins with one of a system, which is always kept; the others alternate
        place, head, held = 0, [], None
        nth = -(sum(x != "D" for x in r["audit"]) % 2)
        for letter in r["audit"]:
            role = "assistant" if nth % 2 else "user"
            if letter == "I":
                head.append(f"{role}:")
            else:
                if held:
                    yield held
                held = {"_conv": r["_conv"], "_place": place, "verb": letter, "new_role": role, "head": "\n".join(head) if head else None, "tail": None}
                place, head = place + 1, []
            nth += letter != "D"
        if held:
            yield held | {"tail": "\n".join(head) if head else None}


def _hashes(parts: DataFrame) -> DataFrame:
    """(_conv, repaired_sha256) of the parts in order, joined by line ends; a task holds a batch and one running hash."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for conv, part in zip(batch.column("_conv").to_pylist(), batch.column("part")):
                part = part.as_py()
                if conv != now:
                    if now is not None:
                        done.append((now, running.hexdigest()))
                    now, running = conv, hashlib.sha256(part.encode("utf-8", "surrogatepass"))
                else:
                    running.update(b"\n" + part.encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in range(2)], ["_conv", "repaired_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (now, running.hexdigest())], ["_conv", "repaired_sha256"])

    return parts.repartition("_conv").sortWithinPartitions("_conv", "_place").select("_conv", "part").mapInArrow(run, "_conv string, repaired_sha256 string")


# --- the operator --------------------------------------------------------------------------------------------------

def edits(rows: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Per conversation of ``rows`` (_conv, _place, _turn, _initial, _fault, _digest): gaps, faults, cost and audit."""
    facts = staged(rows.select("_conv", "_place", "_turn", "_initial", "_fault", "_digest"), "turn-facts")
    firsts = facts.where("_fault != 'b'").groupBy("_conv", "_digest").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    firsts = staged(firsts.where("_n > 1").drop("_n"), "turn-firsts")
    fault = F.when((F.col("_fault") != "b") & (F.col("_place") != F.col("_first")), "d").otherwise(F.col("_fault"))
    marked = facts.join(firsts, ["_conv", "_digest"], "left").withColumn("_fault", fault)
    each = F.array_sort(F.collect_list(F.struct("_place", F.concat("_initial", "_fault").alias("code"))))
    turns = F.array_distinct(F.collect_list("_turn"))
    blocks = marked.groupBy("_conv", F.floor(F.col("_place") / block).alias("_block")).agg(
        *[F.count_if(F.col("_fault") == f).alias(n) for f, n in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
        F.array_join(F.transform(each, lambda x: x["code"]), "").alias("codes"), F.size(turns).cast("long").alias("n_turns"),
        F.min("_turn").alias("first_turn"), F.max("_turn").alias("last_turn"))
    pieces = staged(_step(blocks, PIECE, _solve), "turn-pieces")
    while (pieces.agg(F.max("_block").alias("m")).first()["m"] or 0) > 0:
        whole = F.struct(*[c for c in pieces.columns if c != "_conv"])
        many = pieces.groupBy("_conv", F.floor(F.col("_block") / fan).alias("_to")).agg(F.collect_list(whole).alias("pieces")).withColumnRenamed("_to", "_block")
        pieces = staged(_step(many, PIECE, _join, 1), "turn-pieces")
    return _step(pieces, "_conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string", _finish)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(_conv, _place, part): the repaired turns in order, as ``role:text`` lines; deleted rows without inserts beside them have none."""
    verbs = _step(found.select("_conv", "audit"), "_conv string, _place long, verb string, new_role string, head string, tail string", _spread, 1)
    own = F.when(F.col("verb") != "D", F.concat(F.when(F.col("verb") == "K", F.col("_role")).otherwise(F.col("new_role")), F.lit(":"), F.col("_text")))
    # a row of verbs is wider than the audit letter its size is guessed from: never broadcast
    parts = rows.select("_conv", "_place", "_role", "_text").join(verbs.hint("merge"), ["_conv", "_place"])
    parts = parts.select("_conv", "_place", "head", own.alias("own"), "tail").where("head is not null or own is not null or tail is not null")
    return parts.select("_conv", "_place", F.concat_ws("\n", "head", "own", "tail").alias("part"))


def repair(conversations: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256."""
    rows = placed(damaged(conversations))
    found = staged(edits(rows, block, fan), "turn-edits")
    sums = staged(_hashes(repaired(rows, found)), "turn-hashes")
    every = conversations.select("conv_id").distinct().withColumn("_conv", conv_key("conv_id"))
    zero = F.lit(0).cast("long")
    return every.join(found, "_conv", "left").join(sums, "_conv", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
