"""Exponentially weighted means and running totals as a two-level scan.

The recurrence ``y = (w*y_prev + alpha*x) / (w + alpha)``, where w is (1-alpha) to the
number of rows since the previous value, is affine in the state that enters a block. So a
block is first scanned as if the series started there, using running window sums; one
summary row per block is folded along the series to get the entering state; and that state
corrects the block's rows: ``y = y_local + q * delta``.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.series import add_columns
from barloom.operators.blocks import BLOCK, BLOCK_ROWS, Blocked, split_series
from barloom.operators.stages import Stages
from barloom.session import written

# Where nulls can occur in a scanned column: nowhere, only before its first value, or anywhere.
NEVER, LEADING, ANYWHERE = "never", "leading", "anywhere"


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1)


def wilder_alpha(period: int) -> float:
    return 1.0 / period


@dataclass(frozen=True)
class Ewm:
    """Weighted mean of column ``x``; null until ``min_periods`` values were seen."""

    out: str
    x: str
    alpha: float
    min_periods: int = 1
    nulls: str = ANYWHERE
    # Where nulls can occur if the columns of ``made_of`` hold none.
    made_of: tuple[str, ...] = ()
    otherwise: str = ANYWHERE

    def __post_init__(self) -> None:
        if not 0 < self.alpha <= 1:
            raise ValueError("alpha must be in (0, 1]")

    def given(self, full: Collection[str]) -> Ewm:
        """The scan for a table in which the columns ``full`` hold no null."""
        known = self.made_of and set(self.made_of) <= set(full)
        return replace(self, nulls=self.otherwise) if known else self


@dataclass(frozen=True)
class Total:
    """Running total of column ``x``; null values count as nothing."""

    out: str
    x: str


Scan = Ewm | Total


def block_rows_for(scans: Sequence[Scan], rows: int = BLOCK_ROWS) -> int:
    """Longest block in which the powers of (1-alpha) stay within double range."""
    for s in scans:
        if isinstance(s, Ewm) and s.alpha < 1:
            rows = min(rows, int(250 * math.log(10) / -math.log1p(-s.alpha)))
    return rows


def _num(x: float) -> str:
    return f"{x!r}D"


class BlockScan:
    """The local part of a set of scans, its block summaries and the final columns.

    The window columns come in three layers (positions, gap weights, sums) that a caller can
    put into the same projections as its own window columns.
    """

    def __init__(
        self, blocked: Blocked, scans: Sequence[Scan], level: str, entering: DataFrame | None = None
    ):
        self.b, self.level, self.w, self.entering = blocked, level, blocked.window, entering
        self.scans = list({s.out: s for s in scans}.values())
        self.means = [s for s in self.scans if isinstance(s, Ewm)]

    def _n(self, s: Scan, part: str) -> str:
        return f"_{self.level}_{part}_{s.out}"

    def _m(self, s: Ewm, part: str) -> str:
        # Positions depend only on where x is null, so scans of one column share them.
        return f"_{self.level}_{part}_{s.x}"

    @property
    def _row(self) -> str:
        return f"_{self.level}_row"

    def start(self) -> dict[str, str]:
        """Layer 0: the row number inside the block. It depends on no scanned column."""
        return {self._row: f"count({self.b.live('1')}) {self.w.running}"} if self.scans else {}

    def positions(self) -> dict[str, str]:
        """Layer 1: running totals, and the rows of the first, last and previous value."""
        w, row, cols = self.w, self._row, {}
        for s in self.scans:
            x = self.b.live(f"`{s.x}`")
            if isinstance(s, Total):
                cols[self._n(s, "y")] = f"sum({x}) {w.running}"
                continue
            if s.nulls == NEVER:
                cols[self._m(s, "first")] = self.b.live("1L")
                cols[self._m(s, "at")] = cols[self._m(s, "seen")] = self.b.live(row)
                continue
            at = f"CASE WHEN {x} IS NOT NULL THEN {row} END"
            cols[self._m(s, "first")] = f"min({at}) {w.running}"
            cols[self._m(s, "at")] = f"max({at}) {w.running}"
            cols[self._m(s, "seen")] = f"count({at}) {w.running}"
            if s.nulls == ANYWHERE:
                cols[self._m(s, "prev")] = f"max({at}) {w.before}"
        return cols

    def gaps(self) -> dict[str, str]:
        """Layer 2: log of the weight lost to null gaps; a gap of one row has the factor 1."""
        cols = {}
        for s in self.means:
            if s.nulls == ANYWHERE and s.alpha < 1:
                here = f"{self.b.live(f'`{s.x}`')} IS NOT NULL AND {self._m(s, 'prev')} IS NOT NULL"
                log = f"CASE WHEN {here} THEN ln({self._weight(s)}) ELSE 0D END"
                cols[self._n(s, "gap")] = f"sum({log}) {self.w.running}"
        return cols

    def scale(self) -> dict[str, str]:
        """Plain: the factor of the block's first value in the value at this row."""
        cols = {}
        for s in self.means:
            if s.alpha < 1:
                q = f"pow({_num(1 - s.alpha)}, {self._m(s, 'at')} - {self._m(s, 'first')})"
                if s.nulls == ANYWHERE:
                    q += f" * exp(-{self._n(s, 'gap')})"
                cols[self._n(s, "q")] = q
        return cols

    def sums(self) -> dict[str, str]:
        """Layer 3: the mean as if the series started with this block."""
        cols = {}
        for s in self.means:
            x, q = self.b.live(f"`{s.x}`"), self._n(s, "q")
            if s.alpha == 1:
                cols[self._n(s, "y")] = f"last({x}, true) {self.w.running}"
                continue
            added = f"{_num(s.alpha)} * {x}"
            if s.nulls == ANYWHERE:
                added = f"{added} / {self._weight(s)}"
            term = (
                f"CASE WHEN {x} IS NULL THEN NULL"
                f" WHEN {self._row} = {self._m(s, 'first')} THEN {x} ELSE {added} / {q} END"
            )
            cols[self._n(s, "y")] = f"{q} * sum({term}) {self.w.running}"
        return cols

    def _weight(self, s: Ewm) -> str:
        """(1-alpha)**gap + alpha at a value row that follows another value in the block."""
        gap = f"{self._m(s, 'at')} - {self._m(s, 'prev')}"
        return (
            f"CASE WHEN {gap} > 1 THEN pow({_num(1 - s.alpha)}, {gap}) + {_num(s.alpha)} ELSE 1D END"
        )

    def summaries(self, local: DataFrame) -> DataFrame:
        """One row per (series, block, scan) from the last row of every block."""
        w, key = self.w, self.b.key
        ends = {"_ends": f"lead(`{self.b.order}`) {w.over()} IS NULL"}
        for s in self.means:
            ends[self._n(s, "x1")] = f"first({self.b.live(f'`{s.x}`')}, true) {w.running}"
        entries = []
        for i, s in enumerate(self.scans):
            parts = dict.fromkeys(("alpha", "x1", "q"), "CAST(NULL AS DOUBLE)")
            parts |= dict.fromkeys(("first", "at", "seen"), "CAST(NULL AS BIGINT)")
            if isinstance(s, Ewm):
                parts |= {"alpha": _num(s.alpha), "x1": f"CAST({self._n(s, 'x1')} AS DOUBLE)"}
                parts |= {p: self._m(s, p) for p in ("first", "at", "seen")}
                parts["q"] = self._n(s, "q") if s.alpha < 1 else "0D"
            named = ", ".join(f"'{n}', {sql}" for n, sql in sorted(parts.items()))
            y = f"CAST({self._n(s, 'y')} AS DOUBLE)"
            entries.append(f"named_struct('scan', {i}, 'y', {y}, {named})")
        return (
            add_columns(local, ends)
            .where("_ends")
            .selectExpr(key, BLOCK, f"{self._row} AS rows", f"inline(array({', '.join(entries)}))")
        )

    def _before(self, summaries: DataFrame) -> DataFrame:
        """The stored states (key, scans: those of ``states``) as summaries of a block before all others."""
        names = ", ".join(f"'{s.out}'" for s in self.scans)
        alphas = ", ".join(_num(s.alpha) if isinstance(s, Ewm) else "NULL" for s in self.scans)
        own = self.entering.selectExpr(self.b.key, "inline(scans)").selectExpr(
            self.b.key, "y", "gap", "seen", f"array_position(array({names}), scan) - 1 AS i"
        )
        # A block of ``gap`` rows without a value behind its only one leaves just this state.
        values = {
            self.b.key: self.b.key, BLOCK: "-1", "rows": "gap", "scan": "i", "y": "y", "first": "0", "at": "0",
            "alpha": f"get(array({alphas}), CAST(i AS INT))", "x1": "y", "q": "0", "seen": "seen",
        }
        fields = [f"CAST({values[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in summaries.schema]
        return own.where("i >= 0").selectExpr(*fields)

    def carries(self, local: DataFrame) -> DataFrame:
        """The state entering each block, one row per (series, block).

        The fold runs over one entry per block of a series: with a daily series of a few
        decades that is some ten entries, and the calendar limits it in any case.
        """
        start = """named_struct(
            'out', CAST(array() AS ARRAY<STRUCT<blk: BIGINT, delta: DOUBLE, y: DOUBLE, gap: BIGINT, seen: BIGINT>>),
            'y', CAST(NULL AS DOUBLE), 'gap', 0L, 'seen', 0L)"""
        pull = (
            "pow(1D - e.alpha, a.gap + e.first) / (pow(1D - e.alpha, a.gap + e.first) + e.alpha)"
            " * (a.y - e.x1)"
        )
        delta = f"CASE WHEN e.alpha IS NULL THEN a.y ELSE coalesce({pull}, 0D) END"
        step = f"""(a, e) -> named_struct(
            'out', concat(a.out, array(named_struct(
                'blk', e.{BLOCK}, 'delta', {delta}, 'y', a.y, 'gap', a.gap, 'seen', a.seen))),
            'y', CASE WHEN e.alpha IS NULL THEN coalesce(a.y + e.y, a.y, e.y)
                      WHEN e.seen > 0 THEN e.y + e.q * ({delta}) ELSE a.y END,
            'gap', CASE WHEN e.seen > 0 THEN e.rows - e.at ELSE a.gap + e.rows END,
            'seen', a.seen + coalesce(e.seen, 0L))"""
        entry = f"struct({BLOCK}, rows, scan, y, alpha, at, first, q, seen, x1)"
        summaries = self.summaries(local)
        if self.entering is not None:
            summaries = summaries.unionByName(self._before(summaries))
        states = (
            summaries.groupBy(self.b.key, "scan")
            .agg(F.expr(f"sort_array(collect_list({entry}))").alias("es"))
            .selectExpr(self.b.key, "scan", f"explode(aggregate(es, {start}, {step}).out) AS c")
        )
        picks = [
            F.expr(f"max(CASE WHEN scan = {i} THEN c.{part} END)").alias(self._n(s, f"in_{part}"))
            for i, s in enumerate(self.scans)
            for part in ("delta", "y", "gap", "seen")
        ]
        return states.groupBy(self.b.key, F.col("c.blk").alias(BLOCK)).agg(*picks)

    def finish(self, stages: Stages) -> Stages:
        """Add the scans' output columns to stages that end with the three layers.

        The carries are written: they are small, one row per block, and a later level that reads
        this one would otherwise work them out once more.
        """
        if not self.scans:
            return stages
        if self.b.split:
            local = stages.df
            carries = written(self.carries(local), "carries")
            stages = Stages(local.join(carries, [self.b.key, BLOCK], "left"))
        out: dict[str, str] = {}
        for s in self.scans:
            y = self._n(s, "y")
            if isinstance(s, Total):
                carry = self._n(s, "in_delta")
                out[s.out] = f"coalesce({y} + {carry}, {y}, {carry})" if self.b.split else y
                continue
            seen = self._m(s, "seen")
            if self.b.split:
                q = self._n(s, "q") if s.alpha < 1 else "0D"
                y = f"coalesce({y} + {q} * {self._n(s, 'in_delta')}, {self._n(s, 'in_y')})"
                seen = f"coalesce({seen}, 0L) + {self._n(s, 'in_seen')}"
            if s.min_periods > 1:
                y = f"CASE WHEN {seen} >= {s.min_periods} THEN {y} END"
            out[s.out] = y
        stages.add(out)
        return stages

    def states(self) -> list[str]:
        """SQL of the state behind a row, one struct (scan, y, gap, seen) per scan, after ``finish``.

        y is the mean whether or not it counts yet, gap the rows since its last value.
        """
        if not self.b.split:
            raise ValueError("states are kept for split series only")
        out = []
        for s in self.scans:
            y, gap, seen = f"CAST(`{s.out}` AS DOUBLE)", "0L", "0L"
            if isinstance(s, Ewm):
                here = f"coalesce({self._m(s, 'seen')}, 0L)"
                q = self._n(s, "q") if s.alpha < 1 else "0D"
                local = self._n(s, "y")
                y = f"CAST(coalesce({local} + {q} * {self._n(s, 'in_delta')}, {self._n(s, 'in_y')}) AS DOUBLE)"
                since = f"{self._row} - {self._m(s, 'at')}"
                gap = f"CASE WHEN {here} > 0 THEN {since} ELSE {self._n(s, 'in_gap')} + {self._row} END"
                seen = f"{here} + {self._n(s, 'in_seen')}"
            out.append(f"named_struct('scan', '{s.out}', 'y', {y}, 'gap', {gap}, 'seen', {seen})")
        return out


def ewm(
    df: DataFrame,
    scans: Sequence[Scan],
    key: str = "symbol",
    order: str = "date",
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the output column of every scan to ``df`` (unique on key and order)."""
    rows = block_rows_for(scans, rows)
    blocked = split_series(df, halo=0, rows=rows, key=key, order=order)
    scan = BlockScan(blocked, scans, "s")
    stages = Stages(blocked.df)
    for layer in (scan.start, scan.positions, scan.gaps, scan.scale, scan.sums):
        stages.add(layer())
    out = scan.finish(stages).df
    return out.select(*df.columns, *[s.out for s in scan.scans])
