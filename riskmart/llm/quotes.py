"""Quotation linking of conversations, in DataFrame functions only.

A line is quoted as deep as the number of ``>`` marks in front of it (blanks between them allowed). The lines of a message that are
quoted least deep are those of the message it answers. Quoted and own lines are normalised (letters and digits, lower case) and hashed; a
quoted line points to the latest earlier message of its conversation that has it as a line of its own. Quoted lines that nobody has as a line
(rewrapped, shortened, cut) are read as passages: each five words in a row of one depth, over the ends of lines, that touch such a line point
to the latest earlier message that has them in a row. The message that most lines and word runs point to is the parent, ties go to the
latest; fewer than five quoted words link as a whole line only. A quoted line leaves the message only if it, or every word of it within found runs, stands in an earlier message. Messages without a parent start a thread. Conversations are ordered
so that every reply stands below what it answers: by the path of turns from the start of the thread.

No pairs are made: for each (conversation, line hash) one pass over its turns carries the latest earlier owner along, in blocks of turns
whose last owner is summed up first, so that a line said in a third of all messages is spread. Depths, starts of threads and the reply order (a tour of
each tree, ranked as a list) grow by doubling, in rows of fixed width: a chain of n replies costs n rows a round, in about log2(2 n) rounds.

Defined cases: NULL conversations are one conversation, another than that named by the empty text; a NULL turn can neither be quoted nor quote and comes last; NULL text is an empty
message; several messages of one turn share its place in the tree, and stand in the order of role and a hash of the text; equal messages share one place; messages that quote
what nobody said, or only blanks, start a thread; further columns are ignored. Cycles cannot occur, parents are earlier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.common import ranked
from riskmart.session import staged

MARKS = r"^((?:[ \t]*>)+)"
#: Turns carried along in one block.
BLOCK = 1024
#: Words in a row that tell a passage.
GRAM = 5


def message_key(role: str = "role", text: str = "text"):
    """Equal messages of one turn share a key."""
    return F.xxhash64(F.coalesce(role, F.lit("")), F.coalesce(text, F.lit("")))


def cleaned(line):
    """Letters and digits of a line without its marks, lower case, in words."""
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[^\p{L}\p{N}]+", " ")))


def marks_of(line):
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def parsed(messages: DataFrame) -> DataFrame:
    """(ck, turn, m, line, depth, hash, n_words): every line that has a letter or digit; ``ck`` is the conversation as text, NULL as a text of its own."""
    at = messages.select("ck", "turn", message_key().alias("m"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "_t"))
    at = at.select("ck", "turn", "m", "line", marks_of(F.col("_t")).alias("depth"), cleaned(F.col("_t")).alias("_c"))
    return at.where(F.col("_c") != "").select("ck", "turn", "m", "line", "depth", F.xxhash64("_c").alias("hash"), F.size(F.split("_c", " ")).alias("n_words"))


def passages(messages: DataFrame) -> DataFrame:
    """(ck, turn, m, at, depth, hash, lines): the ``GRAM`` words in a row from word ``at`` on that stand at one depth, over the ends of lines, and the line of each."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x, i: F.transform(
        F.filter(F.split(cleaned(x), " "), lambda w: w != ""), lambda w: F.struct(w.alias("w"), i.alias("line"), marks_of(x).alias("depth"))))
    at = messages.select("ck", "turn", message_key().alias("m"), F.flatten(lines).alias("_w")).where(F.size("_w") >= GRAM)
    at = at.select("ck", "turn", "m", "_w", F.explode(F.sequence(F.lit(0), F.size("_w") - GRAM)).alias("at"))
    word = [F.col("_w")[F.col("at") + k] for k in range(GRAM)]
    alike = F.lit(True)
    for x in word[1:]:
        alike = alike & (x["depth"] == word[0]["depth"])
    return at.where(alike).select("ck", "turn", "m", "at", word[0]["depth"].alias("depth"), F.xxhash64(*[x["w"] for x in word]).alias("hash"), F.array(*[x["line"] for x in word]).alias("lines"))


def own_text(text: str = "text"):
    """The text without its quoted lines."""
    return F.trim(F.array_join(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~x.rlike(MARKS)), "\n"))


def said_text(text: str, placed: str):
    """The text without the quoted lines whose numbers are in ``placed``, and without quoted blanks."""
    def stays(x, i):
        return ~x.rlike(MARKS) | ((F.trim(F.regexp_replace(x, MARKS, "")) != "") & ~F.coalesce(F.array_contains(placed, i), F.lit(False)))
    return F.trim(F.array_join(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), stays), "\n"))


def latest(own: DataFrame, asked: DataFrame) -> DataFrame:
    """(ck, hash, turn, votes, parent): ``asked`` (ck, hash, turn, votes) with the latest earlier turn of ``own`` (ck, hash, turn); rows without one go."""
    both = own.select("ck", "hash", "turn", F.col("turn").alias("said"), F.lit(None).cast("long").alias("votes"))
    both = both.unionByName(asked.select("ck", "hash", "turn", F.lit(None).cast(dict(own.dtypes)["turn"]).alias("said"), "votes"))
    # only what somebody quotes matters
    both = staged(both.join(asked.select("ck", "hash").distinct(), ["ck", "hash"]).withColumn("_block", F.floor(F.col("turn") / BLOCK)), "said")
    key = ["ck", "hash"]
    blocks = both.groupBy(*key, "_block").agg(F.max("said").alias("_last"))
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*key, "_block", F.max("_last").over(before).alias("_carried"))
    inside = Window.partitionBy(*key, "_block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("_near", F.max("said").over(inside)).where("votes IS NOT NULL").join(blocks, [*key, "_block"])
    found = found.withColumn("parent", F.coalesce("_near", "_carried")).where("parent IS NOT NULL")
    return staged(found.select(*key, "turn", "votes", "parent"), "found")


def parents(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ck, turn, parent, votes) for each message that quotes an earlier one, and (ck, turn, m, placed): the numbers of the quoted lines that have an original."""
    lines = staged(parsed(messages).where(F.col("turn").isNotNull()), "message-lines")
    least = lines.where("depth > 0").groupBy("ck", "turn").agg(F.min("depth").alias("_depth"))  # combines before the shuffle, so a turn of very many lines is no task
    quoted = lines.where("depth > 0").join(least, ["ck", "turn"]).withColumn("_least", F.col("_depth") == F.col("depth")).drop("_depth")
    quoted = staged(quoted, "quoted-lines")
    own = lines.where("depth = 0").select("ck", "hash", "turn").distinct()
    found = latest(own, quoted.groupBy("ck", "hash", "turn").agg(F.count(F.when(F.col("_least"), 1)).alias("votes")))
    spot = ["ck", "turn", "m", "line"]
    placed = quoted.join(found.select("ck", "hash", "turn"), ["ck", "hash", "turn"], "left_semi").select(*spot)
    open_lines = staged(quoted.join(found.select("ck", "hash", "turn"), ["ck", "hash", "turn"], "left_anti").select(*spot, "n_words", "_least"), "open-lines")
    tally = found.select("ck", "turn", "parent", "votes")
    if not open_lines.isEmpty():  # rewrapped, shortened, cut or from elsewhere
        grams = staged(passages(messages.where(F.col("turn").isNotNull()).join(open_lines.select("ck").distinct(), "ck", "left_semi")), "grams")
        mine = grams.where("depth > 0").withColumn("nth", F.sequence(F.lit(0), F.lit(GRAM - 1)))
        words = mine.select("ck", "turn", "m", "at", "hash", F.explode(F.arrays_zip("lines", "nth")).alias("_x")).select(
            "ck", "turn", "m", "at", "hash", F.col("_x.lines").alias("line"), (F.col("at") + F.col("_x.nth")).alias("word"))
        words = staged(words.join(open_lines, spot), "open-words")
        per = words.select("ck", "turn", "m", "at", "hash", "_least").distinct()
        seen = latest(grams.where("depth = 0").select("ck", "hash", "turn").distinct(),
                      per.groupBy("ck", "hash", "turn").agg(F.count(F.when(F.col("_least"), 1)).alias("votes")))
        tally = tally.unionByName(seen.select("ck", "turn", "parent", "votes"))
        covered = words.join(seen.select("ck", "hash", "turn"), ["ck", "hash", "turn"], "left_semi").select(*spot, "n_words", "word").distinct()
        placed = placed.unionByName(covered.groupBy(*spot, "n_words").count().where("count = n_words").select(*spot))
    tally = tally.groupBy("ck", "turn", "parent").agg(F.sum("votes").alias("votes")).where("votes > 0")
    best = tally.groupBy("ck", "turn").agg(F.max(F.struct("votes", "parent")).alias("_b"))
    return best.select("ck", "turn", "_b.parent", "_b.votes"), placed.groupBy("ck", "turn", "m").agg(F.collect_set("line").alias("placed"))


def threads(answers: DataFrame) -> DataFrame:
    """(ck, turn, thread_turn, depth) of each answering turn. The known stretch upwards doubles each round; rows keep their width."""
    above = answers.select("ck", F.col("turn").alias("top"), F.lit(True).alias("_more"))
    at = answers.select("ck", "turn", F.col("parent").alias("top"), F.lit(1).cast("long").alias("depth")).join(above, ["ck", "top"], "left")
    at = staged(at.select("ck", "turn", "top", "depth", F.col("_more").isNull().alias("done")), "threads")
    while not at.where("NOT done").isEmpty():
        up = at.select("ck", F.col("turn").alias("top"), F.col("top").alias("_top"), F.col("depth").alias("_depth"), F.col("done").alias("_done"))
        further = at.where("NOT done").join(up, ["ck", "top"]).select("ck", "turn", F.col("_top").alias("top"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_done").alias("done"))
        at = staged(at.where("done").unionByName(further), "threads")
    return at.select("ck", "turn", F.col("top").alias("thread_turn"), "depth")


def tour(answers: DataFrame, heads: DataFrame) -> DataFrame:
    """(ck, turn, left): turns of the thread from this one to the end of the reply order, for all turns of threads with answers.

    The tour enters and leaves every turn once, replies in the order of turns; the list is ranked by doubling, in rows of one width.
    """
    turn = dict(answers.dtypes)["turn"]
    kids = staged(ranked(answers.select("ck", "parent", "turn"), ["ck", "parent"], "nth", ["turn"]), "replies")
    nodes = answers.select("ck", "turn").unionByName(heads.select("ck", F.col("thread_turn").alias("turn")).distinct())
    first = kids.where("nth = 0").select("ck", F.col("parent").alias("turn"), F.col("turn").alias("_to"))
    enter = nodes.join(first, ["ck", "turn"], "left").select(
        "ck", "turn", F.lit(False).alias("out"), F.coalesce("_to", "turn").alias("to_turn"), F.col("_to").isNull().alias("to_out"), F.lit(1).cast("long").alias("left"))
    later = kids.select("ck", "parent", (F.col("nth") - 1).alias("nth"), F.col("turn").alias("_to"))
    leave = kids.join(later, ["ck", "parent", "nth"], "left").select(
        "ck", "turn", F.lit(True).alias("out"), F.coalesce("_to", "parent").alias("to_turn"), F.col("_to").isNull().alias("to_out"), F.lit(0).cast("long").alias("left"))
    last = heads.select("ck", F.col("thread_turn").alias("turn")).distinct().select(
        "ck", "turn", F.lit(True).alias("out"), F.lit(None).cast(turn).alias("to_turn"), F.lit(None).cast("boolean").alias("to_out"), F.lit(0).cast("long").alias("left"))
    at = staged(enter.unionByName(leave).unionByName(last), "tour")
    while not at.where("to_turn IS NOT NULL").isEmpty():
        ahead = at.select("ck", F.col("turn").alias("to_turn"), F.col("out").alias("to_out"), F.col("to_turn").alias("_turn"), F.col("to_out").alias("_out"), F.col("left").alias("_left"))
        further = at.where("to_turn IS NOT NULL").join(ahead, ["ck", "to_turn", "to_out"]).select(
            "ck", "turn", "out", F.col("_turn").alias("to_turn"), F.col("_out").alias("to_out"), (F.col("left") + F.col("_left")).alias("left"))
        at = staged(at.where("to_turn IS NULL").unionByName(further), "tour")
    return at.where("NOT out").select("ck", "turn", "left")


def link(messages: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, role, body (without quotes), said (with the quoted lines that have no original), parent_turn, votes, thread_turn, depth, place (0, 1, ... in its conversation)."""
    known = messages.select("conv_id", "turn", "role", "text").withColumn("ck", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    answers, placed = parents(known)
    answers, placed = staged(answers, "answers"), staged(placed, "placed-lines")
    tops = staged(threads(answers), "tops")
    tree = answers.join(tops, ["ck", "turn"])
    out = known.withColumn("m", message_key()).join(placed, ["ck", "turn", "m"], "left").join(tree, ["ck", "turn"], "left").join(tour(answers, tops), ["ck", "turn"], "left")
    out = staged(out.select(
        "conv_id", "ck", "turn", "role", own_text().alias("body"), said_text("text", "placed").alias("said"), F.col("parent").alias("parent_turn"), F.coalesce("votes", F.lit(0)).alias("votes"),
        F.coalesce("thread_turn", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0)).cast("int").alias("depth"),
        F.coalesce(-F.col("left"), F.lit(0)).alias("_order"), F.col("turn").isNull().alias("_no_turn")), "linked-messages")
    # the bodies stay behind while places are found
    row = ["ck", "_no_turn", "thread_turn", "_order", "role", "body_hash", "said_hash"]
    keyed = out.withColumn("body_hash", F.xxhash64("body")).withColumn("said_hash", F.xxhash64("said"))
    placed = ranked(staged(keyed.select(*row).distinct(), "places"), ["ck"], "place", row[1:])
    placed = placed.select(*[F.col(c).alias(f"p_{c}") for c in row], "place")
    same = F.lit(True)
    for c in row:
        same = same & keyed[c].eqNullSafe(placed[f"p_{c}"])
    return keyed.join(placed, same).select("conv_id", "turn", "role", "body", "said", "parent_turn", "votes", "thread_turn", "depth", "place")


def rendered(linked: DataFrame, chunk: int = 256) -> DataFrame:
    """Chat texts: (conv_id, chunk, text), at most ``chunk`` messages in each, in reply order; no conversation is gathered whole."""
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), "said")
    at = linked.select("conv_id", F.floor(F.col("place") / chunk).alias("chunk"), F.struct("place", line.alias("line")).alias("_m"))
    got = at.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list("_m")).alias("_m"))
    return got.select("conv_id", "chunk", F.array_join(F.transform("_m", lambda m: m["line"]), "\n").alias("text"))
