"""Chat formatting by quotation linking.

Each message is parsed into its own words and its quoted passages: runs of
lines with one depth of ``>`` marks (attribution lines that announce a quote
belong to it). Passages, their paragraphs and their lines are normalised (white space,
case, punctuation at the ends) and hashed, as are the own words of every
message; a quote joins the message it repeats:

- the last earlier message of its conversation that holds the passage, found
  by one ordered pass over each (conversation, hash) and not by pairs;
- else the first message, by conversation and turn, of any other conversation
  that holds it. Conversation ids are no time order, so it may sort after.

A passage under MIN_PASSAGE characters says little by itself: it links only
within its conversation, and only if it is all of the quote or all of the
message it repeats.

A message replies to the message of its longest linked passage of depth 1.
Such links may close a cycle across conversations. The first message of a
cycle, in the order of (conversation, turn), then takes its longest passage
whose source sorts before it, or none; its quotes still count as linked.

A chat is all trees of replies whose roots lie in one conversation: roots by
turn, a reply behind what it replies to, replies to one message by conversation
and turn. The trees are numbered without paths: an Euler tour (enter a message,
its replies one by one, leave it) is a linked list, and pointer doubling ranks
it, so a thread of n replies takes log2 n rounds of n rows. ``build_chats``
writes each chat in parts of PART messages in that order, so no chat is
gathered in one row or task, however long it is. Quotes found in full, whole or
line by line, are left out; a quote that is not, with the line that announces
it, stays as written, since its words are nowhere else.

Windows by turn go in two levels (blocks of turns, then inside a block), so a
phrase that a whole conversation repeats is no single task.

Defined results: a null text has no words; a null role is ``unknown``; a null
conversation or turn comes before all others and is no other's; rows that share
conversation and turn are formatted each, next to each other, and a link to
them is to their turn; negative numbers sort as numbers; a very long text is
parsed whole; an empty table gives no rows; other columns are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kit

MARK = re.compile(r"^((?:[ \t]*>)+)[ \t]?(.*)$")
ATTRIBUTION = re.compile(r"^.{0,200}\b(?:wrote|writes|said|schrieb|a écrit|escribió)\b.{0,20}:\s*$", re.IGNORECASE)
SPACES = re.compile(r"\s+")
#: Passages of fewer characters link only within their conversation.
MIN_PASSAGE = 12
#: Stands for a null conversation or turn, before all others.
FIRST = -(1 << 62)
#: Binary logarithms of the turns of a block and of the conversations of a block of replies, and messages of a part.
TURNS, CONVERSATIONS, PART = 10, 10, 256
TOLD = "told array<struct<depth:int,passage:string,whole:boolean,quote:long,line:boolean,lines:int>>, pieces array<struct<quote:long,text:string>>"


def runs(text: str | None) -> list[tuple[int, str, str]]:
    """The message cut where the depth of quoting changes: (depth, lines as written, lines without marks), in order.

    The line that announces a quote stands at the head of its lines as written.
    """
    found: list[tuple[int, list[str], list[str]]] = []
    for line in (text or "").split("\n"):
        m = MARK.match(line)
        depth = m[1].count(">") if m else 0
        if not found or found[-1][0] != depth:
            head: list[str] = []
            if depth and found and not found[-1][0]:
                _, written, plain = found[-1]
                while written and not written[-1].strip():
                    written.pop(), plain.pop()
                if written and ATTRIBUTION.match(written[-1].strip()):
                    head, _ = [written.pop()], plain.pop()
            found.append((depth, head, []))
        found[-1][1].append(line)
        found[-1][2].append(m[2] if m else line)
    for depth, _, plain in found:
        while depth and plain and ATTRIBUTION.match(plain[-1].strip()):
            plain.pop()
    return [(depth, "\n".join(written), "\n".join(plain)) for depth, written, plain in found if written]


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """Own words of a message and its quoted passages with their depths, in order."""
    cut = runs(text)
    body = re.sub(r"\n{3,}", "\n\n", "\n".join(written for depth, written, _ in cut if not depth)).strip()
    return body, [(depth, plain) for depth, _, plain in cut if depth and plain.strip()]


def normal(text: str) -> str:
    return SPACES.sub(" ", text).strip(" \t\r\n.,;:!?\"'*_").lower()


def passages(text: str) -> set[str]:
    """The whole text, its paragraphs and its lines, normalised."""
    every = [text, *re.split(r"\n\s*\n", text), *text.split("\n")]
    return {p for p in map(normal, every) if p}


def _name(passage: str) -> int:
    """What a quote goes by: a hash of its normalised text, so the same quote of repeated rows is one."""
    return int.from_bytes(hashlib.blake2b(passage.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _parse_rows(batches):
    passage = pa.struct([("depth", pa.int32()), ("passage", pa.string()), ("whole", pa.bool_()), ("quote", pa.int64()), ("line", pa.bool_()), ("lines", pa.int32())])
    kind, piece = pa.list_(passage), pa.list_(pa.struct([("quote", pa.int64()), ("text", pa.string())]))
    for batch in batches:
        body, n_quotes, told, pieces = [], [], [], []
        for text in batch.column("text"):
            text = text.as_py()
            own, quotes = parse(text)
            body.append(own)
            n_quotes.append(len(quotes))
            found = []
            for depth, said in [(0, own), *quotes]:
                whole, lines = normal(said), {p for p in map(normal, said.split("\n")) if p} if depth else set()
                found += [{"depth": depth, "passage": p, "whole": p == whole, "quote": _name(whole), "line": p in lines, "lines": len(lines)} for p in sorted(passages(said))]
            told.append(found)
            pieces.append([{"quote": _name(normal(plain)) if depth and normal(plain) else None, "text": written} for depth, written, plain in runs(text)] if quotes else [])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", "turn", "role")), pa.array(body, pa.string()), pa.array(n_quotes, pa.int64()), pa.array(told, kind), pa.array(pieces, piece)],
            ["conv_id", "turn", "role", "body", "n_quotes", "told", "pieces"],
        )


def before(df: DataFrame, keys: list[str], by: str, columns: dict, agg, width: int) -> DataFrame:
    """df with, for each row, agg of the columns over the rows of its keys with a smaller `by`: inside blocks of 2**width, then over blocks."""
    rows = df.withColumns({**columns, "_block": F.shiftright(by, width)})
    inside = Window.partitionBy(*keys, "_block").orderBy(by).rangeBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*keys, "_block").agg(*(agg(c).alias(c) for c in columns))
    over = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = blocks.select(*keys, "_block", *(agg(c).over(over).alias(f"_{c}") for c in columns))
    both = lambda c: F.greatest(agg(c).over(inside), f"_{c}") if agg is F.max else F.coalesce(agg(c).over(inside), F.lit(0)) + F.coalesce(f"_{c}", F.lit(0))
    return rows.join(ahead, [*keys, "_block"]).withColumns({c: both(c) for c in columns}).drop("_block", *(f"_{c}" for c in columns))


def link_quotes(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent, ordered, n_linked, gone) of the messages whose quotes were found, saved; no null ids. gone: the quotes found in full."""
    n = F.length("p.passage")
    # A short passage is hashed with its conversation, so it never meets others'.
    place = F.when(n < MIN_PASSAGE, F.concat(F.col("conv_id").cast("string"), F.lit("\n"))).otherwise(F.lit(""))
    hashed = messages.select("conv_id", "turn", F.explode("told").alias("p")).select(
        "conv_id", "turn", F.col("p.depth").alias("depth"), "p.whole", "p.quote", "p.line", "p.lines", n.alias("n"), F.sha2(F.concat(place, F.col("p.passage")).cast("binary"), 256).alias("hash")
    )
    quoted = hashed.where("depth > 0").select("hash").distinct()
    # Only passages that someone quotes go on.
    rows = kit.save(hashed.join(quoted, "hash", "left_semi"), "quote-passages")
    held = F.col("depth") == 0
    near = before(rows, ["conv_id", "hash"], "turn", {"any": F.when(held, F.col("turn")), "all": F.when(held & F.col("whole"), F.col("turn"))}, F.max, TURNS).where("depth > 0")
    near = near.withColumn("near", F.when((F.col("n") >= MIN_PASSAGE) | F.col("whole"), F.col("any")).otherwise(F.col("all")))
    # The first holders in the first two conversations: one of them is not the quote's own.
    holders = rows.where(held & (F.col("n") >= MIN_PASSAGE)).groupBy("hash", "conv_id").agg(F.min("turn").alias("turn"))
    one = holders.groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("first"))
    two = holders.join(one, "hash").where(F.col("conv_id") != F.col("first.conv_id")).groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("second"))
    origin = one.join(two, "hash", "left")
    me = F.struct("conv_id", "turn")
    fits = lambda c: F.col(c).isNotNull() & ((F.col(f"{c}.conv_id") != F.col("conv_id")) | (F.col(c) < me))
    found = near.join(origin, "hash", "left").select(
        "conv_id", "turn", "depth", "n", "hash", "whole", "quote", "line", "lines",
        F.when(F.col("near").isNotNull(), F.struct("conv_id", F.col("near").alias("turn"))).when(fits("first"), F.col("first")).when(fits("second"), F.col("second")).alias("source"),
    ).where("source is not null")
    best = lambda which: F.max(F.when((F.col("depth") == 1) & which, F.struct("n", "source")))["source"]
    links = found.groupBy("conv_id", "turn").agg(best(F.lit(True)).alias("parent"), best(F.col("source") < me).alias("ordered"), F.count("*").alias("n_linked"))
    # Quotes that are found: whole, or line by line.
    each = found.groupBy("conv_id", "turn", "quote").agg(((F.max("whole")) | (F.count_distinct(F.when(F.col("line"), F.col("hash"))) == F.max("lines"))).alias("all"))
    gone = each.where("all").groupBy("conv_id", "turn").agg(F.collect_set("quote").alias("gone"))
    links = links.join(gone, ["conv_id", "turn"], "left")
    return break_cycles(kit.save(links, "quote-links"))


def break_cycles(links: DataFrame) -> DataFrame:
    """The first message of every cycle takes its ordered parent; a message is changed at most once.

    After as many jumps as there are messages still on a path, doubled each
    round, a path has ended or stands on a cycle: where the jumps land is the
    cycle, and the smallest message they passed from there is its first.
    """
    me = F.struct("conv_id", "turn")
    while True:
        # A cycle needs a link to a later message; no link, no cycle.
        if not links.where(F.col("parent") > me).take(1):
            return links
        named = links.where("parent is not null")
        state = kit.save(named.select(me.alias("at"), F.col("parent").alias("to"), F.least(me, F.col("parent")).alias("least")), "quote-cycles")
        alive, jumps = state.count(), 1
        while alive and jumps < alive:
            ahead = state.select(F.col("at").alias("to"), F.col("to").alias("next"), F.col("least").alias("other"))
            new = kit.save(state.join(ahead, "to").select("at", F.col("next").alias("to"), F.least("least", "other").alias("least")), "quote-cycles")
            kit.drop_saved(state)
            state, jumps = new, 2 * jumps
            alive = state.count()
        on = state.select(F.col("to").alias("at")).distinct()
        cut = state.join(on, "at", "left_semi").where("at = least").select(F.col("at.conv_id").alias("conv_id"), F.col("at.turn").alias("turn"), F.lit(True).alias("cut"))
        if alive == 0 or not cut.take(1):
            kit.drop_saved(state)
            return links
        new = links.join(cut, ["conv_id", "turn"], "left").select("conv_id", "turn", F.when(F.col("cut"), F.col("ordered")).otherwise(F.col("parent")).alias("parent"), "ordered", "n_linked", "gone")
        new = kit.save(new, "quote-links")
        kit.drop_saved(state)
        kit.drop_saved(links)
        links = new


def siblings(links: DataFrame) -> DataFrame:
    """(conv_id, turn, parent, next, head): the next reply to the same parent, and whether a reply is the first; in blocks of conversations."""
    me = F.struct("conv_id", "turn")
    rows = links.select("conv_id", "turn", "parent", me.alias("me"), F.shiftright("conv_id", CONVERSATIONS).alias("block"))
    inside, over = Window.partitionBy("parent", "block").orderBy("me"), Window.partitionBy("parent").orderBy("block")
    blocks = rows.groupBy("parent", "block").agg(F.min("me").alias("least"))
    blocks = blocks.select("parent", "block", F.lead("least").over(over).alias("later"), F.when(F.row_number().over(over) == 1, F.col("least")).alias("start"))
    rows = rows.withColumn("next", F.lead("me").over(inside)).join(blocks, ["parent", "block"])
    return rows.select("conv_id", "turn", "parent", F.coalesce("next", "later").alias("next"), F.coalesce(F.col("me") == F.col("start"), F.lit(False)).alias("head"))


def number_replies(links: DataFrame) -> DataFrame:
    """(conv_id, turn, root_conv, root_turn, place, depth) of all messages in trees of more than one: place counts from the root, 0, in reply order."""
    linked = kit.save(siblings(links.where("parent is not null")), "quote-siblings")
    first = linked.where("head").select(F.col("parent.conv_id").alias("conv_id"), F.col("parent.turn").alias("turn"), F.struct("conv_id", "turn").alias("child"))
    nodes = linked.select("conv_id", "turn", "parent", "next").unionByName(
        first.join(linked, ["conv_id", "turn"], "left_anti").select("conv_id", "turn", F.lit(None).cast("struct<conv_id:long,turn:long>").alias("parent"), F.lit(None).cast("struct<conv_id:long,turn:long>").alias("next"))
    )
    nodes = nodes.join(first, ["conv_id", "turn"], "left")
    state = lambda at, up: F.struct(at["conv_id"].alias("conv_id"), at["turn"].alias("turn"), F.lit(up).alias("up"))
    me = F.struct("conv_id", "turn")
    enter = nodes.select(state(me, 0).alias("at"), F.coalesce(F.when(F.col("child").isNotNull(), state(F.col("child"), 0)), state(me, 1)).alias("to"), F.lit(1).cast("long").alias("down"), F.lit(0).cast("long").alias("up"))
    leave = nodes.select(
        state(me, 1).alias("at"),
        F.when(F.col("next").isNotNull(), state(F.col("next"), 0)).when(F.col("parent").isNotNull(), state(F.col("parent"), 1)).otherwise(state(me, 1)).alias("to"),
        F.lit(0).cast("long").alias("down"), F.when(F.col("parent").isNull() & F.col("next").isNull(), 0).otherwise(1).cast("long").alias("up"),
    )
    # A list ends where a root is left; that state points to itself.
    tour = kit.save(enter.unionByName(leave), "quote-tour")
    while tour.take(1):
        ahead = tour.select(F.col("at").alias("to"), F.col("to").alias("then"), F.col("down").alias("d"), F.col("up").alias("u"))
        new = kit.save(tour.join(ahead, "to").select("at", F.col("then").alias("to"), (F.col("down") + F.col("d")).alias("down"), (F.col("up") + F.col("u")).alias("up"), (F.col("then") != F.col("to")).alias("moved")), "quote-tour")
        kit.drop_saved(tour)
        tour, done = new.drop("moved"), not new.where("moved").take(1)
        if done:
            break
    # What a message has ahead of it, itself included: the later it stands, the less; the deeper, the more is left than entered.
    rest = tour.where("at.up = 0").select(F.col("at.conv_id").alias("conv_id"), F.col("at.turn").alias("turn"), F.col("to.conv_id").alias("root_conv"), F.col("to.turn").alias("root_turn"), "down", "up")
    size = rest.where("conv_id = root_conv and turn = root_turn").select("root_conv", "root_turn", F.col("down").alias("size"))
    return rest.join(size, ["root_conv", "root_turn"]).select("conv_id", "turn", "root_conv", "root_turn", (F.col("size") - F.col("down")).alias("place"), (F.col("up") - F.col("down") + 1).alias("depth"))


def format_chats(conversations: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """A row a message: chat_id, position (its place in the chat, from 0), conv_id, turn, depth, role, parent_conv, parent_turn, n_quotes, n_linked, formatted."""
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(FIRST))
    slim = conversations.select(
        number(conv_col).alias("conv_id"), number(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"), F.col(text_col).cast("string").alias("text")
    )
    parsed = kit.save(slim.mapInArrow(kit.lean(_parse_rows), "conv_id long, turn long, role string, body string, n_quotes long, " + TOLD), "quote-messages")
    links = link_quotes(parsed)
    placed = kit.save(number_replies(links), "quote-places")
    told = kit.save(links.select("conv_id", "turn", F.col("parent.conv_id").alias("parent_conv"), F.col("parent.turn").alias("parent_turn"), "n_linked", "gone"), "quote-told")
    # Places in a chat: how many messages its earlier trees have, then the place in the tree.
    keys = parsed.groupBy("conv_id", "turn").agg(F.count("*").alias("copies"))
    keys = kit.join_small(keys, placed, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "copies", F.coalesce("root_conv", "conv_id").alias("chat"), F.coalesce("root_turn", "turn").alias("root"), F.coalesce("place", F.lit(0)).alias("place"), F.coalesce("depth", F.lit(0)).alias("depth")
    )
    keys = kit.save(keys, "quote-keys")
    trees = before(keys.groupBy("chat", "root").agg(F.sum("copies").alias("size")), ["chat"], "root", {"start": F.col("size")}, F.sum, TURNS).select("chat", "root", "start")
    inner = before(keys, ["chat", "root"], "place", {"inner": F.col("copies")}, F.sum, TURNS)
    keys = inner.join(trees, ["chat", "root"]).select("conv_id", "turn", "chat", "depth", (F.col("start") + F.col("inner")).alias("start"))
    same = Window.partitionBy("conv_id", "turn").orderBy("role", F.xxhash64("body", "pieces"))
    out = parsed.drop("told").withColumn("copy", F.row_number().over(same) - 1).join(keys, ["conv_id", "turn"])
    out = kit.join_small(out, told, ["conv_id", "turn"], "left")
    # A quote without an original is nowhere else, so it stays where it stood.
    lost = lambda p: p["quote"].isNotNull() & ~F.coalesce(F.array_contains("gone", p["quote"]), F.lit(False))
    kept = F.array_join(F.transform(F.filter("pieces", lambda p: p["quote"].isNull() | lost(p)), lambda p: p["text"]), "\n")
    kept = F.regexp_replace(F.regexp_replace(kept, "\n{3,}", "\n\n"), r"(?U)^\s+|\s+$", "")
    out = out.withColumn("body", F.when(F.exists("pieces", lost), kept).otherwise(F.col("body")))
    back = lambda c: F.when(F.col(c) != FIRST, F.col(c))
    return out.select(
        back("chat").alias("chat_id"), (F.col("start") + F.col("copy")).alias("position"), back("conv_id").alias("conv_id"), back("turn").alias("turn"), "depth", "role",
        back("parent_conv").alias("parent_conv"), back("parent_turn").alias("parent_turn"), "n_quotes", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("body"), F.lit("\n<|end|>\n")).alias("formatted"),
    )


def build_chats(conversations: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", part: int = PART) -> DataFrame:
    """The conversations: chat_id, part (from 0), n_messages, n_quotes, n_linked, text; a chat is its parts' texts in order."""
    rows = format_chats(conversations, conv_col, turn_col, role_col, text_col)
    # A group holds at most `part` messages.
    each = F.sort_array(F.collect_list(F.struct("position", "formatted")))
    return rows.groupBy("chat_id", F.floor(F.col("position") / part).alias("part")).agg(
        F.count("*").alias("n_messages"), F.sum("n_quotes").alias("n_quotes"), F.sum("n_linked").alias("n_linked"), F.array_join(F.transform(each, lambda x: x["formatted"]), "").alias("text")
    )
