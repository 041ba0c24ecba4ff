"""Quotation linking: quoted passages to the messages they come from.  DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textsignal.llm.common import box, store

MARK = r"^(?:[ \t]*+>)++"
ATTRIBUTION = r"^\s*On .+ wrote:\s*$"  # fixed value: how mail programs introduce a quote, in English


def normal(text: Column) -> Column:
    """Letters and digits in lower case, all else one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def passage_hash(text: Column) -> Column:
    """Hash of the normalised passage, null if nothing is left of it."""
    return F.when(normal(text) != "", F.md5(normal(text).cast("binary")))


def parsed(text: Column) -> Column:
    """Array of (level, content) per line; the level is the number of leading quote marks."""
    lines = F.split(text, r"\r?\n", -1)

    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, f"({MARK})", 1)
        level = F.length(F.regexp_replace(marks, "[^>]", ""))
        return F.struct(level.alias("level"), F.regexp_replace(x, MARK + r"[ \t]?", "").alias("content"))

    return F.transform(lines, line)


def own_text(text: Column, lines: Column) -> Column:
    """The text without quoted lines and the lines that introduce them; untouched if it quotes nothing.

    An introduction has a quoted line after it, or a blank one and then a quoted one."""

    def introduces(x: Column, i: Column) -> Column:
        after, next_but_one = F.get(lines, i + 1), F.get(lines, i + 2)
        quote = (after["level"] > 0) | ((F.trim(after["content"]) == "") & (F.coalesce(next_but_one["level"], F.lit(0)) > 0))
        return x["content"].rlike(ATTRIBUTION) & F.coalesce(quote, F.lit(False))

    own = F.filter(lines, lambda x, i: (x["level"] == 0) & ~introduces(x, i))
    body = F.array_join(F.transform(own, lambda x: x["content"]), "\n")
    trimmed = F.regexp_replace(F.regexp_replace(body, r"\A\n+", ""), r"\n+\z", "")
    return F.when(F.exists(lines, lambda x: x["level"] > 0), trimmed).otherwise(text)


def quoted_passages(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, key, run, level, hashes): runs of lines of one level, with the hashes of run and lines."""
    me = ["conv_id", "turn", "key"]
    lines = rows.dropDuplicates(me).select(*me, F.posexplode("lines").alias("at", "line"))
    lines = lines.select(*me, "at", "line.level", "line.content").filter("level > 0")
    here = Window.partitionBy(*me).orderBy("at")  # the quoted lines of one message
    before = F.lag(F.struct("at", "level")).over(here)
    fresh = before.isNull() | (before["level"] != F.col("level")) | (before["at"] != F.col("at") - 1)
    runs = lines.withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(here))
    whole = F.array_sort(F.collect_list(F.struct("at", "content")))
    runs = runs.groupBy(*me, "run", "level").agg(whole.alias("lines"))
    contents = F.transform("lines", lambda x: x["content"])
    hashes = F.concat(F.array(passage_hash(F.array_join(contents, "\n"))), F.transform(contents, passage_hash))
    return runs.select(*me, "run", "level", F.filter(hashes, lambda h: h.isNotNull()).alias("hashes"))


def own_passages(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, hash): the message's own text, its paragraphs and its lines."""
    parts = F.concat(F.array("body"), F.split("body", r"\n\s*\n"), F.split("body", r"\r?\n"))
    hashes = rows.select("conv_id", "turn", F.explode(parts).alias("part"))
    return hashes.select("conv_id", "turn", passage_hash(F.col("part")).alias("hash")).filter("hash IS NOT NULL")


def links(rows: DataFrame, quoting: DataFrame) -> DataFrame:
    """(conv_id, turn, key, run, level, to_conv, to_turn): the original of every quoted run, null if there is none.

    The original is the first message of the same conversation, before the quoting one, that says the
    run; else one of its lines, in their order; else the first such message of any
    other conversation.  Originals are, per hash, the least messages of the two least conversations: one of them is another
    conversation, so a line that very many messages repeat is one row of the join.
    """
    quoted = store(quoted_passages(quoting), "quoted")
    asked = quoted.select("conv_id", "turn", "key", "run", F.posexplode("hashes").alias("place", "hash"))
    said = own_passages(rows).join(asked.select("hash").distinct(), "hash", "left_semi")
    near = said.groupBy("conv_id", "hash").agg(F.min("turn").alias("said"))
    far = near.filter("conv_id IS NOT NULL AND said IS NOT NULL")
    far = far.withColumn("rank", F.row_number().over(Window.partitionBy("hash").orderBy("conv_id"))).filter("rank <= 2")
    place = F.struct("conv_id", F.col("said").alias("turn"))
    far = far.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("second"))
    near = near.select(F.col("conv_id").alias("c"), F.col("hash").alias("h"), "said")
    here = (F.col("conv_id") == F.col("c")) & (F.col("hash") == F.col("h")) & (F.col("said") < F.col("turn"))
    found = asked.join(near, here, "left").join(far, "hash", "left")
    elsewhere = F.when(F.col("first")["conv_id"] != F.col("conv_id"), F.col("first"))
    elsewhere = elsewhere.when(F.col("second")["conv_id"] != F.col("conv_id"), F.col("second"))
    choice = F.when(F.col("said").isNotNull(), F.struct(F.lit(0).alias("far"), "place", F.col("conv_id").alias("c"), F.col("said").alias("t")))
    choice = choice.when(
        elsewhere.isNotNull(), F.struct(F.lit(1).alias("far"), "place", elsewhere["conv_id"].alias("c"), elsewhere["turn"].alias("t"))
    )
    best = found.groupBy("conv_id", "turn", "key", "run").agg(F.min(choice).alias("best"))
    best = best.select(
        F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("key").alias("k"), F.col("run").alias("r"), "best"
    )
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("conv_id", "c"), ("turn", "t"), ("key", "k"), ("run", "r"))]
    return quoted.join(best, same[0] & same[1] & same[2] & same[3], "left").select(
        "conv_id", "turn", "key", "run", "level", F.col("best.c").alias("to_conv"), F.col("best.t").alias("to_turn")
    )


def threads(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth) of (conv_id, turn, reply_to): the turn that the chain of replies starts from.

    Pointers are doubled until none moves, each round stored; only replies take part.
    """
    chain = store(
        replies.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")), "threads"
    )
    while True:
        up = chain.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("thread").alias("up"), F.col("depth").alias("more"))
        same = (F.col("conv_id") == F.col("c")) & (F.col("thread") == F.col("t"))
        moved = chain.join(up, same, "left")
        moved = store(
            moved.select(
                "conv_id", "turn", F.coalesce("up", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("up").isNotNull().alias("moved"),
            ),
            "threads",
        )
        chain = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return chain


def link_quotes(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text"
) -> DataFrame:
    """``messages`` with their own text and place in the reply order.

    Adds ``body`` (the text without quotes), ``quote_levels`` (deepest level), ``n_quotes`` (quoted runs), ``n_linked``
    (runs whose original was found), ``reply_to`` (the latest turn of the same conversation quoted at the lowest level
    that links, else null), ``thread`` (the turn from which its chain of replies starts, its own if it
    replies to none) and ``depth``.  Ordered by conversation, thread and turn, every message follows the
    one it answers: replies always quote earlier turns.

    A null text has a null body and quotes nothing; a null conversation or turn links to nothing and
    is its own thread; repeated rows give repeated equal results; two texts at one turn are told
    apart by text, and share a place in the chain: the one that replies to the latest turn counts.  Columns named
    like a result are replaced, all others stay.
    """
    results = ["body", "quote_levels", "n_quotes", "n_linked", "reply_to", "thread", "depth"]
    conv, turn, text = F.col(conv_col), F.col(turn_col), F.col(text_col)
    kept = messages.select(box(messages, *results), conv.alias("conv_id"), turn.alias("turn"), text.alias("text"), F.xxhash64(text).alias("key"))
    rows = kept.drop("row")
    rows = rows.withColumn("lines", parsed(F.coalesce("text", F.lit(""))))
    rows = rows.withColumn("body", own_text(F.col("text"), F.col("lines")))
    quoting = rows.filter(F.col("text").contains(">"))
    found = store(links(rows, quoting), "links")
    inside = F.when(F.col("to_conv") == F.col("conv_id"), F.struct((-F.col("level")).alias("near"), "to_turn"))
    per = found.groupBy("conv_id", "turn", "key").agg(
        F.max("level").alias("quote_levels"),
        F.count(F.lit(1)).alias("n_quotes"),
        F.count("to_turn").alias("n_linked"),
        F.max(inside)["to_turn"].alias("reply_to"),
    )
    per = store(per, "quotes")
    replies = per.filter("reply_to IS NOT NULL").groupBy("conv_id", "turn").agg(F.max("reply_to").alias("reply_to"))
    chain = threads(replies)
    per = per.join(chain, ["conv_id", "turn"], "left").select(
        F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("key").alias("_k"), "quote_levels", "n_quotes", "n_linked",
        "reply_to", "thread", "depth",
    )
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")) & (F.col("key") == F.col("_k"))
    joined = kept.join(per, same, "left")
    text, turn = F.col("text"), F.col("turn")
    lines = parsed(F.coalesce(text, F.lit("")))
    zero = F.lit(0).cast("long")
    return joined.select(
        "row.*",
        F.when(text.contains(">"), own_text(text, lines)).otherwise(text).alias("body"),
        F.coalesce(F.col("quote_levels").cast("long"), zero).alias("quote_levels"),
        F.coalesce("n_quotes", zero).alias("n_quotes"),
        F.coalesce("n_linked", zero).alias("n_linked"),
        F.col("reply_to"),
        F.coalesce("thread", turn).alias("thread"),
        F.coalesce("depth", zero).alias("depth"),
    )
