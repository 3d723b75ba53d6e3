"""The model graph: raw tables -> staging -> intermediate -> marts.

``Models`` wires the job functions together lazily; each property is one
model of the graph, built once per instance. Nothing runs until an action.

    raw ─ staging ─┬─ claims_with_denials ─┬─ denial_fact ─┬─ denial_patterns
                   │                       │               ├─ recoverable_pool
                   └─ reason_economics ────┘               └─ opportunities ─ fix_recommendations
                                           └─ segment_claims ─ denial_patterns
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from remitlens.plans import economics as econ
from remitlens.plans import facts, marts
from remitlens.plans.staging import PROJECTIONS, Staged, stage
from remitlens.sources.raw import RawTables

#: The models behind the staged tables.
MODEL_NAMES = (
    "claims_with_denials", "reason_economics", "denial_fact", "segment_claims", "mart_rollup", "denial_patterns",
    "recoverable_pool", "appealable_share", "opportunities", "fix_recommendations",
)


class Models:
    def __init__(
        self,
        spark: SparkSession,
        raw: RawTables,
        assumptions: DataFrame | None = None,
        top_k: int = 5,
    ):
        self.spark = spark
        self.raw = raw
        self._assumptions = assumptions
        self.top_k = top_k
        self._rollup_stored = False

    @cached_property
    def assumptions(self) -> DataFrame:
        return self._assumptions if self._assumptions is not None else econ.assumptions_frame(self.spark)

    @cached_property
    def staged(self) -> Staged:
        return stage(self.raw)

    @cached_property
    def reason_economics(self) -> DataFrame:
        return econ.reason_economics(self.staged.reason_codes, self.assumptions)

    @cached_property
    def claims_with_denials(self) -> DataFrame:
        s = self.staged
        return facts.claims_with_denials(s.claims, s.encounters, s.denials)

    @cached_property
    def claim_visits(self) -> DataFrame:
        return facts.claim_visits(self.staged.claims, self.staged.encounters)

    @cached_property
    def denied_claims(self) -> DataFrame:
        s = self.staged
        return facts.denied_claims(s.claims, s.encounters, s.denials)

    @cached_property
    def denial_fact(self) -> DataFrame:
        s = self.staged
        return facts.denial_fact(self.denied_claims, s.providers, s.payers, self.reason_economics)

    @cached_property
    def segment_claims(self) -> DataFrame:
        s = self.staged
        return marts.segment_claims(self.claim_visits, s.payers, s.providers)

    @cached_property
    def mart_rollup(self) -> DataFrame:
        return marts.mart_rollup(self.denial_fact)

    def _level(self, name: str) -> DataFrame:
        """The fact's rows of an aggregation level: from the rollup where that
        is stored, otherwise aggregated for this result alone."""
        if self._rollup_stored:
            return marts.level_rows(self.mart_rollup, name)
        rows = {"pattern": marts.pattern_rows, "category": marts.category_rows, "flag": marts.flag_rows, "opportunity": marts.opportunity_rows}
        return rows[name](self.denial_fact)

    @cached_property
    def denial_patterns(self) -> DataFrame:
        return marts.denial_patterns(self._level("pattern"), self.segment_claims)

    @cached_property
    def recoverable_pool(self) -> DataFrame:
        return marts.recoverable_pool(self._level("category"))

    @cached_property
    def appealable_share(self) -> DataFrame:
        return marts.appealable_share(self._level("flag"))

    @cached_property
    def opportunities(self) -> DataFrame:
        return marts.opportunities(self._level("opportunity"))

    @cached_property
    def fix_recommendations(self) -> DataFrame:
        return marts.fix_recommendations(self.opportunities, econ.fix_assumptions(self.assumptions), self.top_k)

    def model(self, name: str) -> DataFrame:
        """One model by its name; only what it needs is planned."""
        if name in PROJECTIONS:
            return self.staged.table(name)
        if name not in MODEL_NAMES:
            raise ValueError(f"unknown model: {name}")
        return getattr(self, name)

    def views(self) -> dict[str, DataFrame]:
        """Every model by name: staging, intermediate and marts."""
        return {name: self.model(name) for name in (*PROJECTIONS, *MODEL_NAMES)}

    def register_views(self, prefix: str = "") -> None:
        """Expose every model to SQL as a temporary view (recomputed on read)."""
        for name, df in self.views().items():
            df.createOrReplaceTempView(prefix + name)

    def with_tables(self, **stored: DataFrame) -> "Models":
        """A copy in which the named models are replaced, e.g. by written tables.

        Everything downstream of a replaced model reads the replacement.
        """
        unknown = set(stored) - set(MODEL_NAMES) - set(PROJECTIONS)
        if unknown:
            raise ValueError(f"unknown models: {sorted(unknown)}")
        other = Models(self.spark, self.raw, self._assumptions, self.top_k)
        own = {k: v for k, v in self.__dict__.items() if k == "staged"}
        staged = {k.removeprefix("stg_"): v for k, v in stored.items() if k in PROJECTIONS}
        other.__dict__.update(own | {k: v for k, v in stored.items() if k in MODEL_NAMES})
        if staged:
            other.__dict__["staged"] = self.staged.replaced(**staged)
        other._rollup_stored = "mart_rollup" in stored or (self._rollup_stored and "denial_fact" not in stored)
        if other._rollup_stored and "mart_rollup" not in stored:
            other.__dict__["mart_rollup"] = self.mart_rollup
        if "claims_with_denials" in stored:
            other.__dict__["claim_visits"] = stored["claims_with_denials"].select(*facts.VISIT_COLUMNS)
        return other

    def checkpointed(self) -> "Models":
        """A copy whose claim grain and denial fact are reliable checkpoints.

        The two tables are written once to the session's checkpoint folder
        (``spark.checkpoint.dir``, a shared folder on a cluster) and every
        model downstream reads them: several marts in one session no longer
        redo the joins, and a lost executor costs a re-read, not a re-join.
        """
        from remitlens.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(self.spark)
        cwd = self.claims_with_denials.checkpoint(eager=True)
        s = self.staged
        fact = facts.denial_fact(cwd, s.providers, s.payers, self.reason_economics).checkpoint(eager=True)
        return self.with_tables(claims_with_denials=cwd, denial_fact=fact)

    def with_fact(self, fact: DataFrame) -> "Models":
        """A copy whose marts read ``fact`` (e.g. a written or checkpointed table)."""
        return self.with_tables(denial_fact=fact)
