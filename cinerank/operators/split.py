"""Splitting, capped sampling and column permutation.

Every operator here is keyed by a hash of the row's own key, so its result does
not depend on partitioning, survives task retries unchanged, and is reproducible
in SQL (md5 exists in both Spark and DuckDB).
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, stored_rows

RATING_KEY = ["user_id", "movie_id", "ts"]


def key_string(cols, *salt) -> Column:
    parts = [F.col(c).cast("string") for c in cols] + [F.lit(str(s)) for s in salt]
    return F.concat_ws("|", *parts)


def hash_int(key: Column, hex_digits: int = 8) -> Column:
    """First ``hex_digits`` hex digits of md5(key) as a non-negative bigint."""
    return F.conv(F.substring(F.md5(key), 1, hex_digits), 16, 10).cast("bigint")


def split_label(key_cols=RATING_KEY, seed: int = 42, train_permille: int = 800) -> Column:
    bucket = hash_int(key_string(key_cols, seed)) % 1000
    return F.when(bucket < train_permille, F.lit("train")).otherwise(F.lit("test"))


def hash_split(df: DataFrame, key_cols=RATING_KEY, seed: int = 42, train_ratio: float = 0.8):
    """(train, test) by md5 of the row key and seed: stable under repartitioning."""
    labelled = df.withColumn("split", split_label(key_cols, seed, int(round(train_ratio * 1000))))
    train = labelled.filter(F.col("split") == "train").drop("split")
    test = labelled.filter(F.col("split") == "test").drop("split")
    return train, test


def with_split(df: DataFrame, key_cols=RATING_KEY, seed: int = 42, train_ratio: float = 0.8) -> DataFrame:
    return df.withColumn("split", split_label(key_cols, seed, int(round(train_ratio * 1000))))


def random_split(df: DataFrame, train_ratio: float = 0.8, seed: int = 42):
    """Spark's ``randomSplit`` (the result depends on the input partitioning)."""
    train, test = df.randomSplit([train_ratio, 1.0 - train_ratio], seed=seed)
    return train, test


def split_summary(labelled: DataFrame) -> DataFrame:
    """Rows and share per split label."""
    counts = labelled.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # two rows: one tiny window
    return counts.select("split", "n", F.round(F.col("n") / total, 6).alias("share"))


#: Samples that a task merges.
MERGE = 32


def _least(batches: Iterator[pa.RecordBatch], n: int, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The ``n`` least rows by ``keys``, of which about 2 n (and one batch) are held at a time."""
    held, rows, most = [], 0, None
    order = [(k, "ascending") for k in keys]
    schema = None
    for batch in batches:
        schema = batch.schema
        part = pa.Table.from_batches([batch])
        if most is not None:
            part = part.filter(pc.less_equal(part[keys[0]], most))
        if part.num_rows:
            held.append(part)
            rows += part.num_rows
        if rows > 2 * n + 10_000:
            best = pa.concat_tables(held)
            best = best.take(pc.sort_indices(best, sort_keys=order, null_placement="at_start")[:n])
            held, rows, most = [best], best.num_rows, best[keys[0]][-1] if n else None
    if held:
        best = pa.concat_tables(held)
        best = best.take(pc.sort_indices(best, sort_keys=order, null_placement="at_start")[:n])
        yield from best.cast(schema).combine_chunks().to_batches()


def sample_cap(df: DataFrame, n: int, key_cols, seed: int = 42, order_cols=None) -> DataFrame:
    """At most ``n`` rows: the ``n`` smallest by md5(key, seed), ties by ``order_cols`` (columns that aren't
    plain values, such as arrays, by a hash).

    A mergeable bottom-k sample: each task keeps its ``n`` least rows while it reads, and samples are merged level by level, so the table is read
    once, at most ``n`` rows of a task are shuffled, and no task holds more than about 2 n rows. Rows pass through Arrow.
    """
    ties = []
    for c in order_cols or df.columns:
        plain = df.schema[c].dataType.typeName() not in ("array", "map", "struct", "variant", "binary", "boolean")
        ties.append((F.col(c) if plain else F.xxhash64(c)).alias(f"_t{len(ties)}"))
    keys = ["_h", *(f"_t{i}" for i in range(len(ties)))]
    hashed = df.select("*", hash_int(key_string(key_cols, seed), 15).alias("_h"), *ties, F.spark_partition_id().alias("_g"))  # 60 bits

    def least(batches):
        yield from _least(batches, n, keys)

    def merged(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_least(group.to_batches(), n, keys), group.schema)

    out = cut_lineage(hashed.mapInArrow(least, hashed.schema))  # a sample per task, so that the number of tasks is known
    samples = (out.agg(F.max("_g")).first()[0] or 0) + 1
    while samples > 1:
        samples = -(-samples // MERGE)
        out = out.withColumn("_g", F.col("_g") % samples)
        out = out.groupBy("_g").applyInArrow(merged, out.schema)
    return out.select(*df.columns)


def global_position(df: DataFrame, order: list, name: str) -> DataFrame:
    """Adds each row's 1-based position in ``order`` over the whole table: range partitions, each
    numbered on its own and moved by the number of rows in those before it."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    # sizes: one row per range partition, so a broadcast of a known size.
    return (ranged.withColumn(name, inside).join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
            .withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before"))


#: A prime under 2^31: squares of residues fit a bigint.
PRIME = 2147483647
ROUNDS = 6
#: Repeats of the bijection that a row may need; rows leave the range with a chance of 1 / sqrt(n) each time.
WALKS = 64


def round_constants(seed: int, label: str) -> list[tuple[int, int]]:
    """Multiplier and addend of each Feistel round, from md5 of seed, label and round."""
    digits = [hashlib.md5(f"{seed}|{label}|{j}".encode()).hexdigest() for j in range(ROUNDS)]
    return [(1 + int(d[:8], 16) % (PRIME - 1), int(d[8:16], 16) % PRIME) for d in digits]


def bijection(pos: str, n: int, seed: int, label: str) -> Column:
    """A keyed permutation of 0 .. n - 1, as an expression of the column ``pos``.

    A Feistel network on (x mod a, x div a) with a = ceil(sqrt n), b = ceil(n / a): each round adds a function of one half to the
    other, modulo a and b by turns. It permutes 0 .. ab - 1; results from n on (fewer than a) are sent through it again until
    they are below n (cycle walking), which permutes 0 .. n - 1.
    """
    a = max(1, math.isqrt(max(n - 1, 0)) + 1) if n > 1 else 1
    b = max(1, -(-n // a))
    rounds = ", ".join(f"named_struct('m', {(a, b)[j % 2]}L, 'c', {c}L, 'd', {d}L)" for j, (c, d) in enumerate(round_constants(seed, label)))
    t = f"((s.r * k.c + k.d) % {PRIME}L)"

    def once(x: str) -> str:
        return (f"aggregate(array({rounds}), named_struct('l', {x} % {a}L, 'r', {x} div {a}L), "
                f"(s, k) -> named_struct('l', s.r, 'r', (s.l + {t} * {t} % {PRIME}L) % k.m), s -> s.l + {a}L * s.r)")

    first = once(f"cast({pos} as bigint)")
    walks = min(a * b - n, WALKS)  # a walk outside the range is no longer than what lies outside
    if walks <= 0:
        return F.expr(first)
    return F.expr(f"aggregate(sequence(1, {walks}), {first}, (x, i) -> if(x < {n}L, x, {once('x')}), "
                  f"x -> if(x < {n}L, x, cast(raise_error('position left the range') as bigint)))")


def bijection_of(pos: np.ndarray, n: int, seed: int, label: str) -> np.ndarray:
    """The same for an array of positions."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1) if n > 1 else 1
    b = max(1, -(-n // a))

    def once(x):
        left, right = x % a, x // a
        for j, (c, d) in enumerate(round_constants(seed, label)):
            t = (right * c + d) % PRIME
            left, right = right, (left + t * t % PRIME) % (a, b)[j % 2]
        return left + a * right

    out = once(pos.astype(np.int64))
    again = np.flatnonzero(out >= n)
    while len(again):
        out[again] = once(out[again])
        again = again[out[again] >= n]
    return out


def bijection_sql(name: str, rows: str, seed: int, label: str) -> list[tuple[str, str]]:
    """The same as CTEs of a recursive query for DuckDB: ``name``(pos, x) for the positions of the table ``rows``."""
    steps = ["x % a as l0", "x // a as r0"]
    for j, (c, d) in enumerate(round_constants(seed, label)):
        t = f"((r{j} * {c} + {d}) % {PRIME})"
        steps += [f"(l{j} + {t} * {t} % {PRIME}) % {'ab'[j % 2]} as r{j + 1}", f"r{j} as l{j + 1}"]
    size = f"select count(*) as n, greatest(1, cast(ceil(sqrt(count(*))) as bigint)) as a from {rows}"
    walk = (f"select pos, cast(pos as bigint) as x, true as again from {rows} union all "
            f"select pos, l{ROUNDS} + a * r{ROUNDS} as x, l{ROUNDS} + a * r{ROUNDS} >= n as again from "
            f"(select *, {', '.join(steps)} from {name}_walk, {name}_size where again) q")
    return [(f"{name}_size", f"select n, a, greatest(1, (n + a - 1) // a) as b from ({size}) q"), (f"{name}_walk", walk),
            (name, f"select pos, x from {name}_walk where not again")]


def _positions(df: DataFrame, order: list, name: str) -> tuple[DataFrame, int]:
    """(``df`` with each row's position from 0 in ``order`` over the whole table, number of rows): range partitions are sorted and numbered where
    they lie, and stored; a position adds the rows of the partitions before. One shuffle."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The number of the partition in the upper bits, that of the row in it in the lower 33.
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    rows = stored_rows(ranged, "positions")
    part = F.shiftright("_id", 33).cast("int")
    sizes = dict(rows.groupBy(part.alias("_part")).count().collect())  # one row per partition
    before = [0, *itertools.accumulate(sizes.get(i, 0) for i in range(max(sizes, default=0) + 1))]
    starts = F.expr(f"array({', '.join(f'{x}L' for x in before)})")
    return rows.withColumn(name, F.element_at(starts, part + 1) + F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id"), before[-1]


def numbered(df: DataFrame, key_cols, seed: int = 42, order_cols=None) -> tuple[DataFrame, int]:
    """(``df`` with ``_pos`` from 0 in the order of md5(key, seed), ties by ``order_cols``; number of rows). One sort, stored."""
    ties = [F.col(c) for c in (order_cols or df.columns)]
    base = df.withColumn("_hr", F.md5(key_string(key_cols, seed)))
    rows, n = _positions(base, [F.col("_hr"), *ties], "_pos")
    return rows.drop("_hr"), n


def permute_column(df: DataFrame, column: str, key_cols, seed: int = 42, order_cols=None) -> DataFrame:
    """Shuffle ``column`` against the other columns, over the whole table.

    Rows are numbered once (md5 of key and seed; ``order_cols`` break ties between rows with equal keys), and the value of row q goes to the
    row that a keyed bijection gives for q. The column's multiset is kept and every other column untouched.
    """
    rows, n = numbered(df, key_cols, seed, order_cols)
    moved = rows.select(bijection("_pos", n, seed, column).alias("_pos"), column)
    return rows.drop(column).join(moved, "_pos").select(*df.columns)


#: A null among the 32-bit values that are sent, and the bits of a null number.
NO_VALUE, NO_NUMBER = -2 ** 31, -1
#: Rows that a task sends at a time.
SENT = 1 << 17


def block_rows(n: int) -> int:
    """Rows of a block: about a 256th of all, but 2^14 at least and 2^20 at most."""
    return min(1 << 20, max(1 << 14, -(-n // 256)))


def permuted_variants(rows: DataFrame, n: int, columns: list[str], number: str, seed: int = 42) -> DataFrame:
    """The ``n`` rows of :func:`numbered` once as they are (_variant = 0) and once for each of ``columns`` (int) with that column
    permuted (_variant = 1, 2, ...): _variant, ``columns`` and ``number`` (double). Column i of row q goes to row ``bijection(q, column i)``.

    Positions are dealt into blocks. A task sends each value, with its place there, to the block of the row that gets it, many to a message; a
    block's task puts them in place. So a value is shuffled once, in 8 bytes, and a task holds one block (44 bytes a row).
    """
    size = block_rows(n)
    last = n - (n - 1) // size * size

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None and batch.num_rows:
                held.append(batch)
                waiting += batch.num_rows
            if not held or (batch is not None and waiting < SENT):
                continue
            table, held, waiting = pa.Table.from_batches(held), [], 0
            pos = table["_pos"].to_numpy()
            values = [table[c].cast(pa.int32()).fill_null(NO_VALUE).to_numpy() for c in columns]
            bits = (table[number].fill_null(0.0).to_numpy() + 0.0).view(np.int64)  # minus zero is zero
            bits[table[number].is_null().to_numpy()] = NO_NUMBER
            out = [], [], []
            for i, column in enumerate([None, *columns]):
                to = pos if column is None else bijection_of(pos, n, seed, column)
                blocks, order = to // size, np.argsort(to // size, kind="stable")
                blocks, places = blocks[order], (to % size).astype(np.int32)[order]
                own = [bits[order], *(v[order] for v in values)] if column is None else [values[i - 1][order]]
                for start, end in itertools.pairwise([0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]):
                    for x, v in zip(out, (blocks[start], i, b"".join([places[start:end].tobytes(), *(o[start:end].tobytes() for o in own)]))):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())], names=["_block", "_what", "_sent"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, got, block = len(columns), 0, None
        for batch in batches:
            for block, what, message in zip(*(c.to_pylist() for c in batch.columns)):
                if not got:
                    m = last if (block + 1) * size > n else size
                    own, moved, bits = np.empty((k, m), np.int32), np.empty((k, m), np.int32), np.empty(m, np.int64)
                if what:
                    count = len(message) // 8
                    moved[what - 1][np.frombuffer(message, np.int32, count)] = np.frombuffer(message, np.int32, count, 4 * count)
                else:
                    count = len(message) // (12 + 4 * k)
                    places = np.frombuffer(message, np.int32, count)
                    bits[places] = np.frombuffer(message, np.uint8, 8 * count, 4 * count).view(np.int64)
                    own[:, places] = np.frombuffer(message, np.int32, k * count, 12 * count).reshape(k, count)
                got += count
        if block is None:
            return
        if got != (k + 1) * m:
            raise ValueError(f"block {block} got {got} values for {m} rows of {k} columns")
        numbers = bits.view(np.float64)
        for variant in range(k + 1):
            for start in range(0, m, 1 << 16):
                part = slice(start, start + (1 << 16))
                arrays = [(moved if i + 1 == variant else own)[i, part] for i in range(k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(arrays[0]), variant, np.int32)), *(pa.array(a, mask=a == NO_VALUE) for a in arrays),
                     pa.array(numbers[part], mask=bits[part] == NO_NUMBER)], names=["_variant", *columns, number])

    dealt = rows.select("_pos", *columns, F.col(number).cast("double").alias(number)).mapInArrow(sent, "_block int, _what int, _sent binary")
    schema = ", ".join(["_variant int", *(f"`{c}` int" for c in columns), f"`{number}` double"])
    return dealt.repartitionById(max(1, -(-n // size)), "_block").mapInArrow(placed, schema)
