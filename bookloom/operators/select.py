"""Greedy choice of a portfolio under byte and token budgets.

The choice is sequential by nature: every pick changes the worth of the others.
Only narrow rows (identifiers, sizes, scores, topics) of at most ``FRONTIER``
works of a corpus reach the one place that chooses, in rounds; scores, bounds and
the reasons of all works left out are computed distributed.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from bookloom.session import materialize

#: Candidates of one corpus that reach one round of the sequential choice at most; no limit on its result.
FRONTIER = 5000
#: Least utility of a work that need not be included.
LEAST_UTILITY = 10.0


@dataclass
class Portfolio:
    """What is chosen so far, and what that does to the worth of other works."""

    bytes_left: float
    tokens_left: float
    covered: dict[str, list[str]] = field(default_factory=dict)
    creators: dict[str, int] = field(default_factory=dict)
    topics: dict[str, int] = field(default_factory=dict)
    topic_creators: set[tuple[str, str]] = field(default_factory=set)

    def worth(self, w: dict, weights: dict[str, float]) -> float:
        """Static utility plus what depends on creators and topics already chosen."""
        n = self.creators.get(w["creator"], 0)
        total = w["static"] - 9 * n**1.55
        if w["cap"] is not None and not math.isnan(w["cap"]) and w["cap"] > 0 and n >= w["cap"]:
            total -= 30 * (n - w["cap"] + 1)
        if w["bundle"] and n:
            total -= 5
        if not len(w["topics"]):
            total -= 5
        for t in w["topics"]:
            k, weight = self.topics.get(t, 0), weights.get(t, 1.0)
            total += weight * (9 if k == 0 else 4 if k == 1 else 1.5 / math.sqrt(k))
            if (t, w["creator"]) not in self.topic_creators:
                total += 2.5 * weight
        return total

    def fits(self, w: dict) -> bool:
        return w["bytes"] <= self.bytes_left and w["tokens"] <= self.tokens_left

    def overlap(self, w: dict) -> list[str]:
        """Chosen works that hold some of the same content, in the order they were chosen."""
        return list(dict.fromkeys(x for c in w["content"] for x in self.covered.get(c, ())))

    def add(self, w: dict) -> None:
        for c in w["content"]:
            self.covered.setdefault(c, []).append(w["id"])
        self.bytes_left -= w["bytes"]
        self.tokens_left -= w["tokens"]
        self.creators[w["creator"]] = self.creators.get(w["creator"], 0) + 1
        for t in w["topics"]:
            self.topics[t] = self.topics.get(t, 0) + 1
            self.topic_creators.add((t, w["creator"]))


def choose(works: list[dict], byte_capacity: float, token_capacity: float, weights: dict[str, float] | None = None, least: float = LEAST_UTILITY) -> list[tuple[str, int | None, str, float]]:
    """(id, place, reason, score) of every work; place is null for works left out.

    Works that must be included come first, by role, priority, damage, relevance
    and size.  Then, again and again, the work of greatest worth that neither
    overlaps nor exceeds the budget, until the best such work is worth less than
    ``least``.  Ties go to priority, fewer tokens, title, id.
    """
    weights = weights or {}
    state = Portfolio(byte_capacity, token_capacity)
    out: list[tuple[str, int | None, str, float]] = []
    place = 0
    pool = {w["id"]: w for w in works}
    for w in sorted((w for w in works if w["must"]), key=lambda w: (-w["role"], -w["priority"], w["damage"], -w["relevance"], w["bytes"], w["title"], w["id"])):
        score, shared = state.worth(w, weights), state.overlap(w)
        if shared:
            out.append((w["id"], None, "must_include_content_overlap:" + ",".join(shared), score))
        elif not state.fits(w):
            out.append((w["id"], None, "must_include_over_capacity", score))
        else:
            place += 1
            state.add(w)
            out.append((w["id"], place, "selected", score))
        del pool[w["id"]]
    while True:
        best = None
        for w in pool.values():
            if not state.fits(w) or any(c in state.covered for c in w["content"]):
                continue
            key = (-state.worth(w, weights), -w["priority"], w["tokens"], w["title"], w["id"])
            if best is None or key < best:
                best = key
        if best is None or -best[0] < least:
            break
        w = pool.pop(best[-1])
        place += 1
        state.add(w)
        out.append((w["id"], place, "selected", -best[0]))
    for w in pool.values():
        shared = state.overlap(w)
        reason = "content_overlap:" + ",".join(shared) if shared else "marginal_value" if state.fits(w) else "capacity"
        out.append((w["id"], None, reason, state.worth(w, weights)))
    return out


def _must_key(w: dict) -> tuple:
    return (-w["role"], -w["priority"], w["damage"], -w["relevance"], w["bytes"], w["title"], w["id"])


def _free(state: Portfolio, w: dict) -> bool:
    """Whether a work still fits and holds nothing chosen; once it doesn't, it never does again."""
    return state.fits(w) and not any(c in state.covered for c in w["content"])


def _first(works: DataFrame, passes: Callable[[dict], float | None], order: list[Column], most: int) -> dict[str, list[dict]]:
    """By corpus the first ``most`` works that pass, in order; ``passes`` gives a work's score, or nothing."""

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            scores = [passes(w) for w in pdf.to_dict("records")]
            yield pdf.assign(score=pd.Series(scores, index=pdf.index, dtype="float64"))[[s is not None for s in scores]]

    rows = works.mapInPandas(scored, StructType([*works.schema.fields, StructField("score", DoubleType())]))
    # part by part, so that no corpus is sorted in one task
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(64)))
    for keys in (["corpus", "_part"], ["corpus"]):
        rows = rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_k") <= most)
    out: dict[str, list[dict]] = {}
    for r in sorted(rows.drop("_part").collect(), key=lambda r: r["_k"]):
        out.setdefault(r["corpus"], []).append(r.asDict())
    return out


def select_portfolio(works: DataFrame, byte_capacity: float, token_capacity: float, weights: dict[str, float] | None = None, least: float = LEAST_UTILITY, most: int = FRONTIER) -> DataFrame:
    """(corpus, id, place, reason, score) of every work: what :func:`choose` gives for each corpus, whatever its size.

    ``works``: corpus, id, title, creator, static, priority, role, relevance,
    must, damage, bytes, tokens, cap, bundle, topics, content.

    Only ``most`` works of a corpus are on the driver at a time.  No pick makes
    another work worth more, smaller or less overlapping, so the score of a work
    at the start of a round bounds it from above for the rest of the choice.  A
    round takes the works first in the order of their scores as they now are,
    and chooses among them until the best could be beaten by one outside; the
    next round looks at all works again.  The first of a round is always chosen.
    """
    weights = weights or {}
    if any(x < 0 for x in weights.values()):
        raise ValueError("a topic's weight is negative: picks could then make other works worth more")
    works = materialize(works.fillna(0, ["role", "priority", "damage", "relevance"]), "works")
    states = {r["corpus"]: Portfolio(byte_capacity, token_capacity) for r in works.select("corpus").distinct().collect()}
    picks: dict[str, list[tuple[dict, float]]] = {c: [] for c in states}

    def pick(w: dict, score: float) -> None:
        picks[w["corpus"]].append((w, score))
        states[w["corpus"]].add(w)

    def rounds(rows: DataFrame, passes: Callable[[dict], float | None], order: list[Column], run: Callable[[Portfolio, list[dict]], None]) -> None:
        going = list(states)
        while going:
            first = _first(rows.where(F.coalesce("corpus", F.lit("")).isin([c or "" for c in going])), passes, order, most)
            for corpus, own in first.items():
                run(states[corpus], own)
            going = [c for c, own in first.items() if len(own) >= most]

    reached: dict[str, tuple] = {}

    def must_passes(w: dict) -> float | None:
        return 0.0 if _free(states[w["corpus"]], w) and (w["corpus"] not in reached or _must_key(w) > reached[w["corpus"]]) else None

    def run_must(state: Portfolio, own: list[dict]) -> None:
        for w in own:
            if _free(state, w):
                pick(w, state.worth(w, weights))
        reached[own[0]["corpus"]] = _must_key(own[-1])

    rounds(works.where("must"), must_passes, [-F.col("role"), -F.col("priority"), F.col("damage"), -F.col("relevance"), F.col("bytes"), F.col("title"), F.col("id")], run_must)
    required = {c: list(own) for c, own in picks.items()}

    def passes(w: dict) -> float | None:
        state = states[w["corpus"]]
        return score if _free(state, w) and (score := state.worth(w, weights)) >= least else None

    def run(state: Portfolio, own: list[dict]) -> None:
        heap = [((-w["score"], -w["priority"], w["tokens"], w["title"], w["id"]), w) for w in own]
        last = heap[-1][0] if len(own) >= most else None
        heapq.heapify(heap)
        while heap and (last is None or heap[0][0] <= last):
            key, w = heapq.heappop(heap)
            if not _free(state, w):
                continue
            now = (-state.worth(w, weights), *key[1:])
            if now == key:
                pick(w, -now[0])
            elif -now[0] >= least:
                heapq.heappush(heap, (now, w))

    rounds(works.where("NOT coalesce(must, false)"), passes, [-F.col("score"), -F.col("priority"), F.col("tokens"), F.col("title"), F.col("id")], run)

    places = {(c, w["id"]): (k, score) for c, own in picks.items() for k, (w, score) in enumerate(own, 1)}

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            # works that must be included are judged by what was chosen before them
            before = {c: (Portfolio(byte_capacity, token_capacity), iter([*own, None])) for c, own in required.items()}
            ahead = {c: next(own) for c, (_, own) in before.items()}
            out, rows = [], pdf.to_dict("records")
            for w in sorted((w for w in rows if w["must"]), key=_must_key) + [w for w in rows if not w["must"]]:
                corpus = w["corpus"]
                if (corpus, w["id"]) in places:
                    place, score = places[corpus, w["id"]]
                    out.append((corpus, w["id"], place, "selected", score))
                    continue
                state, kind = states[corpus], ""
                if w["must"]:
                    (state, own), kind = before[corpus], "must_include_"
                    while ahead[corpus] and _must_key(ahead[corpus][0]) < _must_key(w):
                        state.add(ahead[corpus][0])
                        ahead[corpus] = next(own)
                shared = state.overlap(w)
                reason = "content_overlap:" + ",".join(shared) if shared else "over_capacity" if kind else "marginal_value" if state.fits(w) else "capacity"
                out.append((corpus, w["id"], None, kind + reason, state.worth(w, weights)))
            frame = pd.DataFrame(out, columns=["corpus", "id", "place", "reason", "score"])
            frame["place"] = frame["place"].astype("Int64")
            yield frame

    return works.mapInPandas(named, "corpus string, id string, place bigint, reason string, score double")
