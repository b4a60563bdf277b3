"""Incremental Elo over a stream of match results (ST1 in streaming form).

The batch fold (``operators.ratings``) recomputes history from scratch.
Here results arrive as a Structured Streaming source; each pool keeps its
ratings in ``applyInPandasWithState`` state, and every micro-batch folds
only its new matches, in (date, match_id) order, starting from the stored
ratings. The emitted rows equal the batch fold when each pool's results
arrive in chronological order; a result older than the last one already
folded for its pool is still folded (at arrival) and flagged ``late`` so it
can be reviewed, since a fold cannot be rewound.

State per pool: the ratings map and the last folded (time, match_id), as
JSON text (bounded by the number of entities in the pool).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pitchspark.functions import elo as E
from pitchspark.operators.ratings import _elo_step, prepare_matches

OUTPUT_SCHEMA = ("pool string, match_id long, team_a string, team_b string, elo_a double, elo_b double, "
                 "post_a double, post_b double, late boolean")
STATE_SCHEMA = "ratings string, last_t long, last_id long"


def _fold_batches(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.exists:
        ratings_json, last_t, last_id = state.get
        ratings = json.loads(ratings_json)
    else:
        ratings, last_t, last_id = {}, None, None
    pdf = pd.concat(list(batches), ignore_index=True)
    pdf = pdf.sort_values(["t_order", "match_id"], kind="mergesort")
    out = []
    for r in pdf.itertuples(index=False):
        a, b = str(r.team_a), str(r.team_b)
        ra = ratings.get(a, E.INITIAL_RATING)
        rb = ratings.get(b, E.INITIAL_RATING)
        x = _elo_step(ra, rb, float(r.s), float(r.h), float(r.k), float(r.g_raw))
        ratings[a], ratings[b] = ra + x, rb - x
        late = last_t is not None and (int(r.t_order), int(r.match_id)) < (last_t, last_id)
        if not late:
            last_t, last_id = int(r.t_order), int(r.match_id)
        out.append((str(key[0]), int(r.match_id), a, b, ra, rb, ra + x, rb - x, bool(late)))
    state.update((json.dumps(ratings), last_t, last_id))
    yield pd.DataFrame(out, columns=["pool", "match_id", "team_a", "team_b", "elo_a", "elo_b",
                                     "post_a", "post_b", "late"])


def stream_elo(results: DataFrame, pool: str = "pool") -> DataFrame:
    """Streaming pre-match ratings per result; ``results`` is a streaming DataFrame.

    Columns needed: ``match_id, <pool>, date, team_a, team_b, home_score,
    away_score, tournament, neutral`` (as for the batch fold).
    """
    prepared = prepare_matches(results)
    src = prepared.selectExpr(f"cast(`{pool}` as string) as pool", "cast(match_id as long) as match_id", "_t as t_order",
                              "cast(team_a as string) as team_a", "cast(team_b as string) as team_b",
                              "s", "h", "k", "g_raw")
    return src.groupBy("pool").applyInPandasWithState(
        _fold_batches, OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
