"""Chat formatting with a prefix tree over conversations.

Each turn is written between control strings; control strings inside texts and roles are escaped and
can be unescaped. Turns that several conversations share from their beginning are one node,
emitted once. Nodes come depth first: conversations are ordered by the path of their nodes, and a
node belongs to the first conversation that has it. For each node the output has

* text and token_ids: the formatted turn, n tokens (characters, without a tokenizer);
* loss_from, loss_n: the part of it under the loss mask (the text of assistant turns);
* position: where its first token stands in its conversation: position ids count on from there;
* start and last: where it begins in the depth-first order, and where its subtree ends. A node
  attends to the nodes whose interval start..last holds its own start: its ancestors and itself.

``read_back`` rebuilds conversations from these alone: nodes are dealt to ranges of the depth-first order, together with the
ancestors open there (one path), and read in order with a stack that the intervals fill and empty.

A node's key is a chained hash of roles and texts, so equal beginnings meet in a group-by (combined
before the shuffle; a first turn of a third of all conversations costs a row per task). The order and
all offsets are running sums made in two steps, over ranges of ordered conversations and
then inside each range: no tree, however wide, is gathered in one place.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BEGIN, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"
#: Strings with a meaning in this or other common templates: escaped inside texts.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: The escape of a control string's first character.
FIRST = {"<": "&lt;", "[": "&lsqb;"}


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(FIRST[c[0]] + c[1:]))
    return out


def unescape(text: str) -> str:
    for raw, escaped in FIRST.items():
        text = text.replace(escaped, raw)
    return text.replace("&nl;", "\n").replace("&amp;", "&")


def escape_role(role: Column) -> Column:
    """Roles stand on one line: their line ends are escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    if not (formatted.startswith(BEGIN) and formatted.endswith(END)):
        raise ValueError("not a formatted turn")
    role, _, text = formatted[len(BEGIN):-len(END)].partition(MIDDLE)
    return unescape(role), unescape(text)


def _chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation and turn: adds the turn's number, the chained hash of the path that ends there, and the
    one before. Only the running state of one conversation is held."""
    conv, depth, chain = None, 0, b""
    for batch in batches:
        out = []
        for cid, no_id, text in zip(batch["cid"], batch["no_id"], batch["text"]):
            if conv != (cid, no_id):
                conv, depth, chain = (cid, no_id), 0, b""
            parent = chain
            chain = hashlib.sha256(parent + text.encode("utf-8", "surrogatepass")).digest()[:16]
            out.append((depth, chain.hex(), parent.hex()))
            depth += 1
        yield pd.concat([batch.reset_index(drop=True), pd.DataFrame(out, columns=["depth", "node", "parent"])], axis=1)


def _tokenised(path: str):
    """Adds token ids and the loss mask in tokens; head, text and end of a turn are tokenised apart."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokens = Tokenizer.from_file(path)
        tokens.encode_special_tokens = True
        for batch in batches:
            ids, begins, counts = [], [], []
            for i in range(0, len(batch), 256):
                cut = []
                for text, begin, size in zip(*(batch[c].iloc[i:i + 256] for c in ("text", "body_from", "body_chars"))):
                    cut += [text[:begin], text[begin:begin + size], text[begin + size:]]
                found = [e.ids for e in tokens.encode_batch(cut, add_special_tokens=False)]
                for head, body, end in zip(found[::3], found[1::3], found[2::3]):
                    ids.append(head + body + end), begins.append(len(head)), counts.append(len(body))
            yield batch.assign(token_ids=ids, n=[len(x) for x in ids], loss_from=begins, loss_n=counts)
    return run


def _running(rows: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows before, in the order of ``keys`` (unique): ranges of rows first, then inside each."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(rows.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), f"chat-{name}")
    sums = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))  # a row per range
    sums = sums.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(sums, "_part").withColumn(name, F.col("_before") + F.sum(value).over(inside) - value).drop("_part", "_before")


def prefix_tree(turns: DataFrame, tokenizer: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths). nodes: one row per distinct beginning: node, parent (empty for a first turn), depth, role, text,
    n, loss_from, loss_n, position, start, last (see the module's text) and body_from, body_chars, token_ids. With a tokenizer's file
    the unit of n, loss, position, start and last is its tokens, else characters and token_ids is null.
    paths: (conv_id, cid, no_id, depth, node), one row per turn.

    Turns (conv_id, turn, role, text) are ordered by turn, then role, then text (nulls first; repeated turns are turns
    of their own). A null role or text counts as empty; rows with a null conv_id are one conversation. Equal beginnings
    are merged at any depth: a conversation's path is one sort key of 16 bytes a turn, less than its text. Other
    columns are ignored; an empty table gives empty results.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    head, body = F.concat(F.lit(BEGIN), escape_role(role), F.lit(MIDDLE)), escape(text)
    conv = F.col("conv_id").cast("long")
    rows = turns.select(F.coalesce(conv, F.lit(0)).alias("cid"), conv.isNull().alias("no_id"), F.col("turn").cast("long").alias("turn"),
                        role.alias("role"), text.alias("raw"), F.concat(head, body, F.lit(END)).alias("text"),
                        F.length(head).alias("body_from"), F.length(body).alias("body_chars"))
    rows = rows.repartition("no_id", "cid").sortWithinPartitions("no_id", "cid", "turn", "role", "raw").drop("turn", "raw")
    columns = "cid long, no_id boolean, role string, text string, body_from int, body_chars int"
    chained = written(rows.mapInPandas(_chained, columns + ", depth int, node string, parent string"), "chat-turns")
    paths = chained.select(F.when(~F.col("no_id"), F.col("cid")).alias("conv_id"), "cid", "no_id", "depth", "node")

    nodes = chained.groupBy("node").agg(*[F.first(c).alias(c) for c in ("parent", "depth", "role", "text", "body_from", "body_chars")])
    if tokenizer:
        schema = "node string, parent string, depth int, role string, text string, body_from int, body_chars int"
        nodes = nodes.mapInPandas(_tokenised(tokenizer), schema + ", token_ids array<int>, n long, loss_from int, loss_n int")
    else:
        nodes = nodes.withColumn("token_ids", F.lit(None).cast("array<int>")).withColumn("n", F.length("text").cast("long")).withColumn(
            "loss_from", F.col("body_from")).withColumn("loss_n", F.col("body_chars"))
    nodes = written(nodes.withColumn("loss_n", F.when(F.col("role") == "assistant", F.col("loss_n")).otherwise(0)), "chat-nodes")

    # Conversations in the order of their paths: equal beginnings stand together.
    order = paths.groupBy("cid", "no_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("depth", F.unhex("node").alias("key")))), lambda s: s["key"]).alias("path"))
    order = _running(order, ["path", "no_id", "cid"], F.lit(1).cast("long"), "rank").select("cid", "no_id", "rank")
    along = Window.partitionBy("cid", "no_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    met = paths.join(nodes.select("node", "n"), "node").withColumn("position", F.sum("n").over(along) - F.col("n"))
    met = met.join(order, ["cid", "no_id"]).groupBy("node").agg(F.min("rank").alias("first"), F.max("rank").alias("final"), F.min("position").alias("position"))
    # Offsets are found without texts and ids, which are joined once.
    places = nodes.select("node", "n").join(met, "node")
    # The nodes that a conversation is the first to have are the end of its path.
    fresh = places.groupBy(F.col("first").alias("rank")).agg(F.sum("n").alias("fresh"), F.min("position").alias("skip"))
    ranks = _running(order.join(fresh, "rank", "left").fillna(0, ["fresh", "skip"]), ["rank"], F.col("fresh"), "before")
    places = places.join(ranks.select(F.col("rank").alias("first"), "before", "skip"), "first").join(
        ranks.select(F.col("rank").alias("final"), (F.col("before") + F.col("fresh")).alias("last")), "final")
    places = places.select("node", "position", (F.col("before") + F.col("position") - F.col("skip")).alias("start"), "last")
    return nodes.join(places, "node").select("node", "parent", "depth", "role", "text", "n", "loss_from", "loss_n", "position",
                                             "start", "last", "body_from", "body_chars", "token_ids"), paths


READ = "node string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_ranges(tokenizer: str | None):
    """Rows sorted by range and start: what the path to each node of a range says, from units and intervals."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if tokenizer:
            from tokenizers import Tokenizer
            library = Tokenizer.from_file(tokenizer)

            def written_as(units) -> str:
                return library.decode(units.tolist(), skip_special_tokens=False) if len(units) else ""
        else:
            def written_as(units) -> str:
                return units
        here, path = None, []  # path: (last, end position, digests and counts up to here) of the open nodes
        for batch in batches:
            out = []
            for part, home, node, start, last, position, n, begin, size, units in zip(*(batch[c] for c in (
                    "part", "home", "node", "start", "last", "position", "n", "loss_from", "loss_n", "units"))):
                if part != here:
                    here, path = part, []
                while path and path[-1][0] <= start:
                    path.pop()
                _, at, turns, loss, loss_chars, chars = path[-1] if path else (0, 0, hashlib.sha256(), hashlib.sha256(), 0, 0)
                if position != at or len(units) != n:
                    raise ValueError("positions don't follow the intervals")
                text, turns = written_as(units), turns.copy()
                role, said = read_turn(text)
                turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                if size:
                    masked, loss = unescape(written_as(units[begin:begin + size])), loss.copy()
                    loss_chars += len(masked)
                    loss.update(masked.encode("utf-8", "surrogatepass"))
                path.append((last, at + n, turns, loss, loss_chars, chars + len(text)))
                if home == part:
                    out.append((node, len(path), turns.hexdigest(), loss_chars, loss.hexdigest(), chars + len(text)))
            if out:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in READ.split(", ")])
    return run


def read_back(nodes: DataFrame, paths: DataFrame, tokenizer: str | None = None, width: int = 1 << 18) -> DataFrame:
    """One row per conversation, read from the emitted tree: conv_id, n_turns, turns_sha256 (role, line end, text, line end
    of each turn), loss_chars and loss_sha256 (all text under the loss mask, unescaped), formatted_chars.

    A conversation is the path to its last node: the nodes whose start..last holds that node's start, put together by
    position (a position that doesn't follow raises ValueError). With the tree's ``tokenizer`` texts and the text under the mask are
    decoded from token_ids, else they are cut from ``text`` by characters. Ranges of ``width`` units of the depth-first order
    are read apart; a node comes to each range that its interval meets, at most one path of them to a range besides its own nodes.
    """
    units = F.col("token_ids") if tokenizer else F.col("text")
    home, until = F.floor(F.col("start") / width), F.floor((F.col("last") - 1) / width)
    rows = nodes.select("node", "start", "last", "position", "n", "loss_from", "loss_n", units.alias("units"), home.alias("home"),
                        F.explode(F.sequence(home, until)).alias("part"))
    found = rows.repartition("part").sortWithinPartitions("part", "start").mapInPandas(_read_ranges(tokenizer), READ)
    ends = paths.groupBy("cid", "no_id").agg(F.max_by("node", "depth").alias("node"))
    return ends.join(found, "node").select(F.when(~F.col("no_id"), F.col("cid")).alias("conv_id"), "n_turns", "turns_sha256", "loss_chars",
                                           "loss_sha256", "formatted_chars")
