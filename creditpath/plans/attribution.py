"""End-to-end attribution plans over one touch table.

``AttributionPlan`` wires the operators into lazy DataFrames. Each stage is
built once per plan object, and Spark sees one DAG per action. Nothing is
cached: a plan leaves no storage behind.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import journeys as J
from ..operators import markov as M
from ..operators import matrix as X
from ..operators import touch_models as TM
from ..operators import transitions as TR
from ..operators.report import all_models, attribution_pivot
from ..operators.validate import split_valid
from ..sources.events import touches as event_touches


class AttributionPlan:
    """Lazily built stages of the attribution model for ``touches``.

    ``touches``: ``uid, channel, time, conversion`` (+ optional ``event_id``).
    Rows that fail validation (V1) are set aside in :attr:`rejected`.
    """

    def __init__(
        self,
        touches: DataFrame,
        *,
        validate: bool = True,
        policy: str = "absorbing",
        digits: int | None = None,
        num_partitions: int | None = None,
    ) -> None:
        self.raw_touches = touches
        self.validate = validate
        self.policy = policy
        self.digits = digits
        self.num_partitions = num_partitions

    @classmethod
    def from_events(cls, spark: SparkSession, sf_dir: str, **kw) -> "AttributionPlan":
        return cls(event_touches(spark, sf_dir, kw.get("num_partitions")), **kw)

    # -- touches and journeys -------------------------------------------------
    @cached_property
    def _split(self) -> tuple[DataFrame, DataFrame]:
        if not self.validate:
            empty = self.raw_touches.where(F.lit(False)).withColumn(
                "reject_reason", F.lit(None).cast("string")
            )
            return self.raw_touches, empty
        return split_valid(self.raw_touches)

    @property
    def _touches_ext(self) -> DataFrame:
        """Valid touches, with ``prev_touch`` when the source provides it."""
        return self._split[0]

    @property
    def touches(self) -> DataFrame:
        return self._touches_ext.drop("prev_touch")

    @property
    def rejected(self) -> DataFrame:
        return self._split[1].drop("prev_touch")

    @cached_property
    def visit_order(self) -> DataFrame:
        return J.visit_order(self.touches, self.num_partitions)

    @cached_property
    def journeys(self) -> DataFrame:
        return J.journey_summary(self.touches)

    @cached_property
    def user_journey(self) -> DataFrame:
        return J.user_journey(self.touches, self.num_partitions, summary=self.journeys)

    # -- touch models ----------------------------------------------------------
    @cached_property
    def first_touch(self) -> DataFrame:
        return TM.first_touch(self.journeys, self.digits)

    @cached_property
    def last_touch(self) -> DataFrame:
        return TM.last_touch(self.journeys, self.digits)

    @cached_property
    def touch_attribution(self) -> DataFrame:
        return TM.touch_attribution(self.journeys, self.digits)

    # -- transitions and matrix -------------------------------------------------
    @cached_property
    def edges(self) -> DataFrame:
        return TR.touch_transitions(self._touches_ext, self.journeys, self.num_partitions)

    @cached_property
    def path_transitions(self) -> DataFrame:
        return TR.path_transitions(self.user_journey)

    @cached_property
    def transition_counts(self) -> DataFrame:
        return TR.transition_counts(self.edges)

    @cached_property
    def matrix(self) -> DataFrame:
        return X.transition_matrix(self.transition_counts)

    @cached_property
    def row_sums(self) -> DataFrame:
        return X.row_sums(self.matrix)

    @cached_property
    def adjacency(self) -> DataFrame:
        return X.adjacency(self.matrix)

    def pivot(self, states: list[str] | None = None) -> DataFrame:
        return X.pivot_matrix(self.matrix, states)

    # -- Markov model -------------------------------------------------------------
    @cached_property
    def scenario_graph(self) -> DataFrame:
        return M.scenario_graph(self.matrix)

    def removal_graph(self, channel: str | None) -> DataFrame:
        return M.removal_graph(self.matrix, channel)

    def conversion_probability(self, policy: str | None = None) -> DataFrame:
        return M.conversion_probability(self.matrix, policy or self.policy)

    def removal_effect(self, policy: str | None = None) -> DataFrame:
        return M.removal_effect(self.conversion_probability(policy), self.digits)

    def markov_attribution(self, policy: str | None = None) -> DataFrame:
        return M.markov_attribution(self.removal_effect(policy))

    def all_models(self, policy: str | None = None) -> DataFrame:
        return all_models(self.touch_attribution, self.markov_attribution(policy))

    def attribution_pivot(self, policy: str | None = None) -> DataFrame:
        return attribution_pivot(self.all_models(policy))


def register_views(plan: AttributionPlan, prefix: str = "") -> list[str]:
    """Expose the main stages as temp views for SQL users (names as in the gold layer)."""
    from ..functions.paths import register_sql_functions

    views = {
        "bronze": plan.touches,
        "user_journey_view": plan.user_journey,
        "gold_user_journey": plan.user_journey,
        "attribution_view": plan.touch_attribution,
        "markov_state_transitions": plan.path_transitions,
        "transition_matrix": plan.matrix,
        "markov_chain_attribution_update": plan.markov_attribution(),
    }
    names = []
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    register_sql_functions(plan.raw_touches.sparkSession)
    return names
