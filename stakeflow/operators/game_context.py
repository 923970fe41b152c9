"""What was known of a table's rounds at a bet: by event time, by visible time, and as each bet's own moment saw them.

Rounds come late and are told again. With one observation time, or by visible time, the newest versions make one
timeline, and bets look it up. As seen by each bet, every bet has a timeline of its own: ``context_as_seen`` sweeps
over the versions in the order in which they became visible, and reads each bet's rounds when it is reached.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeflow.operators.asof import asof_join
from stakeflow.operators.dedup import resolved_games
from stakeflow.operators.features import game_timeline

MINUTE = 60_000_000
DAY = 1440 * MINUTE
CONTEXT = ["current_outcome_streak_len", "banker_rate_w20games", "player_rate_w20games", "tie_rate_w20games", "table_num_players", "patron_is_sole_player", "table_turnover_w5m_over_w15m", "table_net_outcome_w15m"]
OUTCOMES = ("BANKER", "PLAYER", "TIE")


def game_context(bets: DataFrame, games: DataFrame, observed_us: int | None = None, end_us: int | None = None, unit: float = MINUTE, bucket: int = DAY) -> DataFrame:
    """Adds CONTEXT and game_id of the round before each bet at its table, 0 and null where there is none.

    With ``observed_us`` rounds visible by then count, and the round before is that by event time. Without it, the newest
    version of each is taken, visible by ``end_us`` if that is given, and the round before is the one that became visible
    last before the bet. Both are strict. The timeline holds what was before a round, so that the newest never counts.
    """
    rounds = resolved_games(games, observed_us if observed_us is not None else end_us)
    line = game_timeline(rounds, unit)
    if observed_us is None:
        line = line.join(rounds.select("game_id", F.col("etl_us").alias("_at")).where("_at is not null"), "game_id").drop("us")
    else:
        line = line.withColumnRenamed("us", "_at")
    out = asof_join(bets, line, "table_id", "us", "_at", strict=True, tie="game_id", bucket=bucket).drop("_at")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in CONTEXT})


def context_as_seen(bets: DataFrame, games: DataFrame, reach: int = 2 * DAY, unit: float = MINUTE) -> DataFrame:
    """bet_id, game_id and CONTEXT of bets (bet_id, table_id, us, seen_us), each by the versions of rounds visible at its
    ``seen_us``.

    Of each round the newest version seen counts, by ts_ms, then etl_us; where that isn't resolved, or its time isn't within
    ``reach`` before the bet, the round doesn't. Of what is left the last round by time and id is the bet's, and its
    context is of the rounds before it. 0 and null without one. Bets without a table or time see nothing; versions
    without a time of either kind aren't seen; repeated bets are rows of their own.

    Tables are cut into spans of ``reach``: a task has the bets of one span and the versions of it and the one before.
    """
    span = lambda c: F.floor(F.col(c) / reach)
    left = bets.select("bet_id", "table_id", "us", "seen_us").withColumn("span", span("us"))
    known = games.where("table_id is not null and us is not null and etl_us is not null and game_id is not null")
    # a version that moves a round to another time takes the one before it away there too
    times = known.select("table_id", "game_id", "us").distinct().select("table_id", "game_id", F.explode(F.array(span("us"), span("us") + 1)).alias("span")).distinct()
    versions = known.select("game_id", "us", "etl_us", "ts_ms", "outcome", "game_status", "num_players", "total_turnover", "casino_win", F.col("table_id").alias("at_table")).join(times.select("game_id", "span", F.col("table_id")).distinct(), "game_id")
    schema = "bet_id long, game_id long, " + ", ".join(f"{c} {'long' if c == CONTEXT[0] else 'int' if c in CONTEXT[4:6] else 'double'}" for c in CONTEXT)

    def swept(b: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("seen_us", kind="stable").reset_index(drop=True)
        out: list[tuple] = [(None, 0, 0.0, 0.0, 0.0, 0, 0, 0.0, 0.0)] * len(b)
        sees = b.index[b["us"].notna() & b["seen_us"].notna() & b["table_id"].notna()]
        if len(sees) and len(v):
            rounds = Rounds(v.sort_values("etl_us", kind="stable"), b["table_id"].iloc[0], unit)
            us = b["us"].loc[sees].to_numpy(np.int64)
            ends, begins = np.searchsorted(rounds.us, us), np.searchsorted(rounds.us, us - reach)
            for i, seen, begin, end in zip(sees.tolist(), b["seen_us"].loc[sees].to_numpy(np.int64).tolist(), begins.tolist(), ends.tolist()):
                rounds.see_until(seen)
                out[i] = rounds.context(begin, end)
        found = pd.DataFrame(out, columns=["game_id", *CONTEXT]).astype({"game_id": "Int64"})
        found.insert(0, "bet_id", b["bet_id"])
        return found

    return left.groupBy("table_id", "span").cogroup(versions.groupBy("table_id", "span")).applyInPandas(swept, schema)


class Places:
    """A set of places below ``n``, in words whose use is a word of its own; -1 is before all."""

    BITS = 9

    def __init__(self, n: int):
        self.words, self.used = [0] * ((n >> self.BITS) + 1), 0

    def put(self, i: int, inside: bool) -> None:
        k, bit = i >> self.BITS, 1 << (i & ((1 << self.BITS) - 1))
        word = self.words[k] | bit if inside else self.words[k] & ~bit
        self.words[k] = word
        self.used = self.used | 1 << k if word else self.used & ~(1 << k)

    def before(self, i: int) -> int:
        """The last one before ``i``."""
        k = i >> self.BITS
        word = self.words[k] & ((1 << (i & ((1 << self.BITS) - 1))) - 1)
        if not word:
            used = self.used & ((1 << k) - 1)
            if not used:
                return -1
            k = used.bit_length() - 1
            word = self.words[k]
        return (k << self.BITS) + word.bit_length() - 1


class Sums:
    """Numbers by place, and sums of ranges over their own numbers: a tree of sums of two."""

    def __init__(self, n: int, zero: float):
        self.n, self.zero, self.tree = n, zero, [zero] * (2 * n)

    def put(self, i: int, value: float) -> None:
        tree, i = self.tree, i + self.n
        tree[i] = value
        while i > 1:
            i >>= 1
            tree[i] = tree[2 * i] + tree[2 * i + 1]

    def of(self, begin: int, end: int) -> float:
        tree, out, i, j = self.tree, self.zero, begin + self.n, end + self.n
        while i < j:
            if i & 1:
                out += tree[i]
                i += 1
            if j & 1:
                j -= 1
                out += tree[j]
            i >>= 1
            j >>= 1
        return out


class Rounds:
    """The resolved rounds of a table by their newest versions seen, in order of time.

    The times and ids that rounds may have are known before, and are places; those that a seen version has are linked in
    order. Where runs of outcomes begin, and sums, are kept as versions come, so that a version or a bet costs the
    logarithm of the places, and not the rounds of its window."""

    def __init__(self, versions: pd.DataFrame, table, unit: float):
        """``versions`` in the order in which they are seen."""
        v = versions
        held = (v["game_status"] == "RESOLVED") & (v["at_table"] == table)
        places = v.loc[held, ["us", "game_id"]].drop_duplicates().sort_values(["us", "game_id"]).reset_index(drop=True)
        self.us, self.ids = places["us"].to_numpy(np.int64), places["game_id"].tolist()
        n = len(places)
        self.after15, self.after5 = (np.searchsorted(self.us, self.us - int(m * unit), "right").tolist() for m in (15, 5))
        at = v[["us", "game_id"]].merge(places.assign(place=places.index), "left", ["us", "game_id"])["place"].fillna(-1).to_numpy(np.int64)
        said = v["outcome"].map({x: k for k, x in enumerate(OUTCOMES)}).fillna(len(OUTCOMES)).to_numpy(np.int64) + v["outcome"].isna().to_numpy()
        number = lambda c, none, kind: v[c].fillna(none).to_numpy(kind).tolist()
        self.rows = list(zip(number("etl_us", 0, np.int64), number("ts_ms", -1, np.int64), pd.factorize(v["game_id"])[0].tolist(), np.where(held, at, -1).tolist(), said.tolist(), number("num_players", 0, np.int64), number("total_turnover", 0.0, float), number("casino_win", 0.0, float)))
        self.at = 0
        self.newest: dict = {}
        self.there, self.begins = Places(n), Places(n)
        self.count, self.turnover, self.win = Sums(n, 0), Sums(n, 0.0), Sums(n, 0.0)
        self.prev, self.next, self.said, self.players, self.first = [-1] * n, [-1] * n, [-1] * n, [0] * n, -1

    def see_until(self, us: int) -> None:
        """Sees the versions that are visible by then."""
        while self.at < len(self.rows) and self.rows[self.at][0] <= us:
            etl, ts, game, place, said, players, turnover, win = self.rows[self.at]
            self.at += 1
            rank, old = (ts, etl), self.newest.get(game)
            if old is not None and old[0] > rank:
                continue
            if old is not None and old[1] >= 0:
                self._take(old[1])
            if place >= 0:
                self._put(place, said, players, turnover, win)
            self.newest[game] = (rank, place)

    def _link(self, before: int, after: int) -> None:
        if before >= 0:
            self.next[before] = after
        else:
            self.first = after
        if after >= 0:
            self.prev[after] = before
            self.begins.put(after, before < 0 or self.said[before] != self.said[after])

    def _put(self, i: int, said: int, players: int, turnover: float, win: float) -> None:
        before = self.there.before(i)
        after = self.next[before] if before >= 0 else self.first
        self.there.put(i, True)
        self.said[i], self.players[i] = said, players
        self.count.put(i, 1)
        self.turnover.put(i, turnover)
        self.win.put(i, win)
        self._link(before, i)
        self._link(i, after)

    def _take(self, i: int) -> None:
        self.there.put(i, False)
        self.begins.put(i, False)
        for sums in (self.count, self.turnover, self.win):
            sums.put(i, sums.zero)
        self._link(self.prev[i], self.next[i])

    def context(self, begin: int, end: int) -> tuple:
        """Of the rounds at places from ``begin`` to before ``end``."""
        last = self.there.before(end)
        if last < begin:
            return None, 0, 0.0, 0.0, 0.0, 0, 0, 0.0, 0.0
        past, told, n = self.prev[last], [0] * (len(OUTCOMES) + 2), 0
        i = past
        while i >= begin and n < 20:
            told[self.said[i]] += 1
            n, i = n + 1, self.prev[i]
        n -= told[-1]  # without an outcome
        shares = [x / n if n else 0.0 for x in told[: len(OUTCOMES)]]
        streak, players = 0, 0
        if past >= begin:
            players = self.players[past]
            if self.said[past] < len(OUTCOMES):
                streak = self.count.of(max(begin, self.begins.before(past + 1)), past + 1)
        # what stands before each round of the last minutes
        since15, since5 = (max(begin, self.there.before(x[last])) for x in (self.after15, self.after5))
        turnover15, turnover5, win = self.turnover.of(since15, last), self.turnover.of(since5, last), self.win.of(since15, last)
        part = turnover5 / turnover15 if turnover15 else 0.0
        return self.ids[last], streak, *shares, players, int(players == 1), max(0.0, min(10.0, part)), max(-1e9, min(1e9, win))
