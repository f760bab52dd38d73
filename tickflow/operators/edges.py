"""Price shifts across pieces of sorted ticks.

A piece is a range of ticks in order of (symbol, time), walked backwards. Only
its last symbol can go on in later pieces, and only its first symbol can have
begun in earlier ones. So a question is open at the edge of a piece if it is
asked there in the last symbol, within the limit of the piece's last tick, and
found nothing; and a later piece has answers in its first symbol, of which only
records count: ticks that no earlier tick of the piece outdoes.

`routes` tells from two ticks' worth of numbers per piece which piece can have
an answer for which. From piece i they lead to those later pieces that beat all
pieces between, as long as these do not beat everything in i. Routes do not
cross, so they are at most about two per piece and direction, they are found in
as many steps, symbol by symbol, and all copies together are about as many as
the ticks, for whatever course of prices.

Prices of `lower` questions are negated, so that larger is always better. Ticks
of one instant are no answers to each other, even where it fills several
pieces: for a question from that instant a piece counts without its first one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.beyond import Scan

_INF = float("inf")
_SIGNS = (1, -1)  # higher, lower
_RECORD = {1: 1, -1: 2}  # bits of `_record`
_PRICES = [f"{name}_{side}" for side in ("up", "down") for name in ("top", "best", "later")]
_ROUTES = ("_at int, _in {symbol}, _targets array<struct<target:int,sign:int,begins:long,best:double,later:double>>, "
           "_askers array<struct<asker:int,sign:int>>")


def walked(ranged: DataFrame, columns: list[str], limit: int, edge: bool) -> DataFrame:
    """Ticks and their distances to the answers in their piece.

    Either those that have nothing to do with an edge, or (`edge`) those that
    ask there, with those that may be records of the piece's first symbol.
    """
    schema = T.StructType([
        *(T.StructField(f.name, f.dataType, True) for f in ranged.select(*columns).schema),
        T.StructField("_higher", T.LongType()), T.StructField("_lower", T.LongType()),
    ])
    if edge:
        schema = schema.add("_piece", T.IntegerType()).add("_n", T.LongType()).add("_us", T.LongType())
        schema = schema.add("_asks", T.BooleanType()).add("_record", T.IntegerType())
    return ranged.mapInArrow(_walk(limit, columns, edge), schema)


def _prices(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("price").to_numpy(zero_copy_only=False).astype(np.float64)


class _Groups:
    """Runs of a symbol in a partition's sorted batches."""

    def __init__(self):
        self.symbol, self.seen, self.first = None, False, True

    def of(self, batch: pa.RecordBatch) -> tuple[np.ndarray, bool]:
        """The runs' numbers in this batch, and whether run 0 goes on from the batch before.
        `first`: run 0 is the partition's first."""
        symbols = batch.column("symbol")
        codes = symbols.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        groups = np.cumsum(np.append(False, codes[1:] != codes[:-1]))
        continued = self.seen and symbols[0].as_py() == self.symbol
        self.first = not self.seen or (self.first and continued and not self.ended)
        self.ended = bool(groups[-1])
        self.symbol, self.seen = symbols[-1].as_py(), True
        return groups, continued


def _walk(limit: int, columns: list[str], edge: bool) -> Callable:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scans = {sign: Scan(limit) for sign in _SIGNS}
        runs, end, rows = _Groups(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups, continued = runs.of(batch)
            us, price = batch.column("_us").to_numpy(), _prices(batch)
            end = us[0] if end is None else end
            near = (groups == 0) & (us + limit > end) if runs.first else np.zeros(len(us), bool)
            if edge and not near.any():
                gaps = {sign: np.full(len(us), -1) for sign in _SIGNS}
            else:
                gaps = {sign: scans[sign].answers(groups, us, sign * price, continued) for sign in _SIGNS}
            asks = near & ~np.isnan(price) & ((gaps[1] < 0) | (gaps[-1] < 0))
            arrays = [batch.column(c) for c in columns] + [pa.array(gaps[s], mask=gaps[s] < 0) for s in _SIGNS]
            names = [*columns, "_higher", "_lower"]
            keep = ~asks
            if edge:
                record = _records(groups, us, price)
                arrays += [batch.column("_piece"), pa.array(rows + np.arange(len(us))), batch.column("_us"),
                           pa.array(asks), pa.array(record)]
                names += ["_piece", "_n", "_us", "_asks", "_record"]
                keep = asks | (record > 0)
            rows += len(us)
            yield pa.RecordBatch.from_arrays(arrays, names=names).filter(pa.array(keep))
    return walk


def _records(groups: np.ndarray, us: np.ndarray, price: np.ndarray) -> np.ndarray:
    """Bits for ticks of the last run that no earlier tick of the batch outdoes.

    Ticks of the earliest instant outdo only each other, as they do not count
    for questions of that instant.
    """
    last = np.flatnonzero(groups == groups[-1])
    earliest = us[last] == us[-1]
    out = np.zeros(len(us), np.int32)
    for sign in _SIGNS:
        value = np.where(np.isnan(price[last]), -_INF, sign * price[last])
        for part in (earliest, ~earliest):
            at, of = last[part], value[part]
            if len(at):
                top = np.maximum.accumulate(of[::-1])[::-1]
                out[at[of > np.append(top[1:], -_INF)]] |= _RECORD[sign]
    return out


def ends(ranged: DataFrame) -> DataFrame:
    """A row per piece: the last instant and extremes of its last symbol, the first instant and extremes of
    its first symbol, these also without the first instant."""
    symbol = ranged.schema["symbol"].dataType
    schema = T.StructType([
        T.StructField("piece", T.IntegerType()), T.StructField("asks", symbol), T.StructField("ends", T.LongType()),
        T.StructField("answers", symbol), T.StructField("begins", T.LongType()),
        *(T.StructField(name, T.DoubleType()) for name in _PRICES),
    ])
    return ranged.mapInArrow(_ends, schema)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs, out = _Groups(), None
    for batch in batches:
        if not batch.num_rows:
            continue
        groups, continued = runs.of(batch)
        us, price = batch.column("_us").to_numpy(), _prices(batch)
        if out is None:
            out = {"piece": batch.column("_piece")[0].as_py(), "asks": batch.column("symbol")[0].as_py(), "ends": int(us[0]),
                   **dict.fromkeys(_PRICES, -_INF)}
        last = groups == groups[-1]
        goes_on = continued and not groups[-1]
        for sign, side in zip(_SIGNS, ("up", "down")):
            value = np.where(np.isnan(price), -_INF, sign * price)
            if runs.first:
                out[f"top_{side}"] = max(out[f"top_{side}"], value[groups == 0].max())
            best, later = value[last].max(), value[last & (us > us[-1])].max(initial=-_INF)
            if goes_on:
                # At an earlier instant than the batches before, all of these are later.
                later = max(later, out[f"later_{side}"] if out["begins"] == us[-1] else out[f"best_{side}"])
                best = max(best, out[f"best_{side}"])
            out[f"best_{side}"], out[f"later_{side}"] = best, later
        out["answers"], out["begins"] = batch.column("symbol")[-1].as_py(), int(us[-1])
        kind = batch.schema.field("symbol").type
    if out is not None:
        names = ["piece", "asks", "ends", "answers", "begins", *_PRICES]
        kinds = [pa.int32(), kind, pa.int64(), kind, pa.int64(), *[pa.float64()] * len(_PRICES)]
        yield pa.RecordBatch.from_arrays([pa.array([out[n]], k) for n, k in zip(names, kinds)], names=names)


def routes(pieces: DataFrame, limit: int) -> DataFrame:
    """Per piece and symbol, from the table of a row per piece: the later pieces that can have an answer for it, the
    nearest first, and the earlier ones that it can have an answer for.

    Pieces meet per symbol, in a chain; a piece whose last symbol is not its first stands in two chains.
    """
    asks, answers = F.col("asks"), F.col("answers")

    def place(symbol: Column, asking: bool, answering: bool) -> Column:
        return F.struct(symbol.alias("symbol"), F.lit(asking).alias("asking"), F.lit(answering).alias("answering"))
    places = F.when(asks.eqNullSafe(answers), F.array(place(asks, True, True))).otherwise(
        F.array(place(asks, True, False), place(answers, False, True)))
    chained = pieces.withColumn("place", F.explode(places)).select("*", "place.*").drop("place", "asks", "answers")
    chained = chained.repartition("symbol").sortWithinPartitions("symbol", F.desc("piece"))
    return chained.mapInArrow(_routes(limit), _ROUTES.format(symbol=pieces.schema["asks"].dataType.simpleString()))


def _routes(limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, chain = _Groups(), []
        for batch in batches:
            if not batch.num_rows:
                continue
            groups, continued = runs.of(batch)
            cuts = np.flatnonzero(np.diff(groups, prepend=-1)).tolist()
            for first, end in zip(cuts, [*cuts[1:], batch.num_rows]):
                if chain and (first or not continued):
                    yield _chain_routes(chain, limit)
                    chain = []
                chain.append(batch.slice(first, end - first))
        if chain:
            yield _chain_routes(chain, limit)
    return run


def _chain_routes(chain: list[pa.RecordBatch], limit: int) -> pa.RecordBatch:
    rows = pa.Table.from_batches(chain)
    pieces = rows["piece"].to_numpy()
    found = []  # asking row, row that may answer, sign
    for sign, side in zip(_SIGNS, ("up", "down")):
        columns = [rows[name].to_pylist() for name in (
            "asking", "answering", "begins", "ends", f"top_{side}", f"best_{side}", f"later_{side}")]
        askers, targets = chain_routes(*columns, limit)
        found.append((np.array(askers, np.int64), np.array(targets, np.int64), np.full(len(askers), sign, np.int32)))
    asker, target, sign = (np.concatenate(parts) for parts in zip(*found))
    best, later = (np.where(sign > 0, rows[f"{name}_up"].to_numpy()[target], rows[f"{name}_down"].to_numpy()[target])
                   for name in ("best", "later"))

    def lists(of: np.ndarray, columns: dict[str, np.ndarray]) -> pa.ListArray:
        order = np.argsort(of, kind="stable")
        offsets = np.searchsorted(of[order], np.arange(len(pieces) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
            [pa.array(column[order]) for column in columns.values()], names=list(columns)))
    return pa.RecordBatch.from_arrays([
        pa.array(pieces, pa.int32()), rows["symbol"].combine_chunks(),
        lists(asker, {"target": pieces[target], "sign": sign, "begins": rows["begins"].to_numpy()[target], "best": best, "later": later}),
        lists(target, {"asker": pieces[asker], "sign": sign})], names=["_at", "_in", "_targets", "_askers"])


def chain_routes(asking: list[bool], answering: list[bool], begins: list[int], ends: list[int], top: list[float],
                 best: list[float], later: list[float], limit: int) -> tuple[list[int], list[int]]:
    """Pairs of an asking piece and one that may answer, the nearest first, for one symbol's pieces from last to first.

    `higher[k]` is the next later piece with a larger best, so following it from
    the piece next to an asker gives the ever larger ones, up to the first that
    beats all of the asker. Those it does not beat are never followed again once
    the asker is an answer itself, so steps add up to about two per piece.

    Where the next piece begins at the instant the asker ends at, questions of
    that instant see pieces that begin then without it: `later` of the last of
    them, and the larger ones after it.
    """
    n = len(best)
    higher, last, after = [-1] * n, list(range(n)), [-1] * n
    askers, targets = [], []

    def beyond(k: int, value: float) -> int:
        while k >= 0 and best[k] <= value:
            k = higher[k]
        return k

    def rising(k: int, i: int) -> list[int]:
        steps = []
        while k >= 0 and begins[k] < ends[i] + limit:
            steps.append(k)
            if best[k] > top[i]:
                break
            k = higher[k]
        return steps

    for i in range(n):
        if asking[i] and i:
            near = i - 1
            at_end = begins[near] == ends[i]
            before_end = not (at_end and answering[i] and begins[i] == ends[i])  # has questions before its last instant
            found = rising(beyond(near, -_INF), i) if before_end else []
            if at_end:
                z = last[near]
                shown = [z] if later[z] > -_INF else []
                if later[z] <= top[i]:
                    shown += rising(after[z], i)
                found = sorted({*found, *shown}, reverse=True)
            askers += [i] * len(found)
            targets += found
        if answering[i]:
            if i and begins[i - 1] == begins[i]:
                last[i] = last[i - 1]
            higher[i] = beyond(i - 1, best[i])
            after[i] = beyond(i - 1, later[i])
    return askers, targets


def placed(edge: DataFrame, columns: list[str], routes_: DataFrame) -> DataFrame:
    """Open questions at the piece that has their answer, and records for the pieces that ask.

    A question carries its tick, a record symbol and price only. What no piece
    can answer stays where it is. Routes are a few numbers for each piece, so
    their size goes with the partitions and not with the ticks.
    """
    known = edge.join(
        F.broadcast(routes_), (F.col("_piece") == F.col("_at")) & F.col("symbol").eqNullSafe(F.col("_in")), "left")

    def spot(target: Column, asker: Column, sign: Column, asks: bool) -> Column:
        return F.struct(target.alias("target"), asker.alias("asker"), sign.alias("sign"), F.lit(asks).alias("asks"))

    def question(sign: int, answer: str) -> Column:
        beats = F.filter("_targets", lambda r: (r["sign"] == sign) & (
            F.when(F.col("_us") < r["begins"], r["best"]).otherwise(r["later"]) > sign * F.col("price")))
        target = F.when(F.col("_asks") & F.col(answer).isNull(), F.get(beats, F.lit(0))["target"])
        return F.when(target.isNotNull(), spot(target, F.col("_piece"), F.lit(sign), True))

    asked = F.array_compact(F.array(question(1, "_higher"), question(-1, "_lower")))
    stays = F.array(spot(F.col("_piece"), F.col("_piece"), F.lit(0), True))
    shown = F.transform(
        F.filter("_askers", lambda r: F.when(r["sign"] == 1, F.col("_record").bitwiseAND(_RECORD[1])).otherwise(
            F.col("_record").bitwiseAND(_RECORD[-1])) > 0),
        lambda r: spot(F.col("_piece"), r["asker"], r["sign"], False))
    spots = F.concat(
        F.when(~F.col("_asks"), F.slice(stays, 1, 0)).when(F.size(asked) > 0, asked).otherwise(stays),
        F.coalesce(shown, F.slice(stays, 1, 0)))
    out = known.withColumn("_spot", F.explode(spots))
    tick = [F.col(c) if c in ("symbol", "price") else F.when(F.col("_spot.asks"), F.col(c)).alias(c) for c in columns]
    return out.select(*tick, "_higher", "_lower", "_n", "_us", *(
        F.col(f"_spot.{name}").alias(f"_{name}") for name in ("target", "asker", "sign", "asks")))


def answered(placed_: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """One row per tick that asked, with its distances. A task holds the records of one piece at a time, for one
    asking piece; questions pass by in batches."""
    keys = ["_target", "_asker", "_sign"]
    in_order = placed_.repartition(*keys).sortWithinPartitions(*keys, "_asks", "_us")
    kept = [*columns, "_higher", "_lower", "_n", "_asker", "_sign"]
    schema = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in placed_.select(*kept).schema),
                           T.StructField("_gap", T.LongType())])
    found = in_order.mapInArrow(_answer(limit, kept), schema)

    def distance(known: str, sign: int) -> Column:
        return F.max(F.coalesce(F.col(known), F.when(F.col("_sign") == sign, F.col("_gap")))).alias(known)
    both = found.groupBy("_asker", "_n").agg(
        F.first(F.struct(*columns)).alias("_tick"), distance("_higher", 1), distance("_lower", -1))
    return both.select(*(F.col(f"_tick.`{c}`").alias(c) for c in columns), "_higher", "_lower")


def _answer(limit: int, kept: list[str]) -> Callable:
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, times, values = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("_target", "_asker", "_sign")])
            asks = batch.column("_asks").to_numpy(zero_copy_only=False).astype(bool)
            us, price = batch.column("_us").to_numpy(), _prices(batch)
            cuts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            gap = np.full(len(us), -1)
            for first, end in zip(cuts, [*cuts[1:], len(us)]):
                here = tuple(keys[:, first].tolist())
                if here != key:
                    key, times, values = here, [], []
                rows = np.arange(first, end)
                times.append(us[rows[~asks[rows]]])
                values.append(here[2] * price[rows[~asks[rows]]])
                rows = rows[asks[rows]]
                if len(rows):
                    times, values = [np.concatenate(times)], [np.concatenate(values)]
                    gap[rows] = _first_beyond(times[0], values[0], us[rows], here[2] * price[rows])
            gap[gap >= limit] = -1
            arrays = [batch.column(c) for c in kept] + [pa.array(gap, mask=gap < 0)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "_gap"]).filter(pa.array(asks))
    return answer


def _first_beyond(times: np.ndarray, values: np.ndarray, us: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Time from each question to the first larger value that is later, or -1. No question is later than the first value."""
    gap = np.full(len(us), -1)
    if not len(times):
        return gap
    same = us == times[0]
    for rows, first in ((~same, 0), (same, int(np.searchsorted(times, times[0], side="right")))):
        stair, at = np.maximum.accumulate(values[first:]), np.flatnonzero(rows)
        step = np.searchsorted(stair, asked[at], side="right")
        hit = step < len(stair)
        gap[at[hit]] = times[first:][step[hit]] - us[at[hit]]
    return gap
