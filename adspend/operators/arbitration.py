"""Key exclusion between stages ("first stage to claim a key wins").

In the sequential ladder, a stage may insert a (publisher, price, campaign) key
only if no *earlier* stage wrote it; rows of one stage never exclude each other.
Starting from an empty ledger that equals: keep the candidates whose stage rank
is the minimum rank of their key. Ties within one stage all stay, so it is
``min``, not ``row_number``.

The run itself needs neither form below: a stage has at most one candidate per price, so
``candidates.claimed_step`` picks the first stage by a CASE. For candidate sets built
elsewhere:

* ``arbitrate_entries``: per campaign row, over the campaign's candidate array.
  Every key contains ``camp_id``, so all rivals of a key sit in the same array. No shuffle.
* ``arbitrate``: over a long candidate frame, a window ``min`` per key (one exchange).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adspend.params import SCENARIO_ORDER


def stage_rank(step: Column, order=SCENARIO_ORDER) -> Column:
    """Position of a step number in the run order (NULL for steps outside it)."""
    out = None
    for i, s in enumerate(order):
        out = F.when(step == s, F.lit(i)) if out is None else out.when(step == s, F.lit(i))
    return out


def arbitrate_entries(cands: Column, order=SCENARIO_ORDER) -> Column:
    """Keep each entry unless an entry of an earlier stage has the same key."""
    def claimed_earlier(x: Column) -> Column:
        return F.exists(cands, lambda y: (y.publisher_id == x.publisher_id)
                        & (y.publisher_cpc == x.publisher_cpc)
                        & (stage_rank(y.step_num, order) < stage_rank(x.step_num, order)))
    return F.filter(cands, lambda x: ~claimed_earlier(x))


def arbitrate(candidates: DataFrame, order=SCENARIO_ORDER) -> DataFrame:
    """Long form: keep rows whose stage rank is the minimum of their key."""
    key = Window.partitionBy("publisher_id", "publisher_cpc", "camp_id")
    rank = stage_rank(F.col("step_num"), order)
    return (candidates.withColumn("_rank", rank)
            .withColumn("_first", F.min("_rank").over(key))
            .filter(F.col("_rank") == F.col("_first"))
            .drop("_rank", "_first"))
