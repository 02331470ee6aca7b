"""Shared building blocks for the named queries.

``Workbench`` holds a session, a table folder and a split, and builds the
stages of the training-data funnel.  Most are lazy; those that several others
read (``decayed_train``, ``popularity``, ``als_input``, the ids and the rule
pairs) are cut: computed once, when first asked for, and read from the shared
checkpoint folder from then on:

    playtime log -> train/test windows (+decay, common users)
      -> per-pair playtime -> confidence labels
      -> + click signals -> merged train pairs / test pairs
      -> popularity, penalty, activity filter -> dense ids -> indexed frames

Every stage reads the provided tables, so the work grows with them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpath.functions.numeric import round_to
from reelpath.operators import indexing, interactions, scoring
from reelpath.sources import fixtures
from reelpath.sources.bundle import cut_lineage
from reelpath.sources.fixtures import DEFAULT_SPLIT, Split
from reelpath.sources.scan import split_windows
from reelpath.sources.shared import SharedFrames

MIN_ITEMS_PER_USER = 3


@dataclass
class Workbench:
    spark: SparkSession
    sf_dir: str
    split: Split = DEFAULT_SPLIT
    decay: bool = True
    penalize: bool = True
    min_items: int = MIN_ITEMS_PER_USER
    #: keeps frames with several readers while it is open
    shared: SharedFrames | None = None
    _memo: dict = field(default_factory=dict, repr=False)

    def _get(self, key, build):
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def _keep(self, df: DataFrame) -> DataFrame:
        return df if self.shared is None else self.shared.keep(df)

    # ---- raw views
    def view(self, name: str) -> DataFrame:
        return self._get(("view", name),
                         lambda: fixtures.SPARK_FIXTURES[name](self.spark, self.sf_dir))

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    # ---- windows
    def playtime_windows(self) -> tuple[DataFrame, DataFrame]:
        return self._get("pt_windows",
                         lambda: split_windows(self.view("playtime"), self.split, decay=self.decay))

    def click_windows(self) -> tuple[DataFrame, DataFrame]:
        """J1 on click pairs: both windows rolled up per pair first."""
        def build():
            train, test = (self._keep(interactions.click_pairs(x)) for x in split_windows(
                self.view("clicks"), self.split, decay=True, common_users=False))
            users = interactions.users_in_both(train, test)
            return tuple(x.join(users, "userId", "left_semi") for x in (train, test))
        return self._get("ck_windows", build)

    # ---- labels and signals
    def pair_stats(self) -> tuple[DataFrame, DataFrame]:
        """J1 + A1: both windows rolled up per pair first, so that a heavy user
        is a few rows before users are compared."""
        def build():
            train, test = split_windows(self.view("playtime"), self.split, decay=self.decay, common_users=False)
            train, test = (self._keep(interactions.aggregate_playtime(x, with_decay=self.decay, drop_invalid=False))
                           for x in (train, test))
            users = interactions.users_in_both(train, test)
            return tuple(interactions.valid_pairs(x.join(users, "userId", "left_semi")) for x in (train, test))
        return self._get("pair_stats", build)

    def decayed_pairs(self) -> DataFrame:
        """J1 + A3 on roll-ups: decayed sums of the train pairs of common users."""
        train, test = split_windows(self.view("playtime"), self.split, decay=True, common_users=False)
        sums = interactions.decayed_playtime(train, drop_invalid=False)
        users = interactions.users_in_both(sums, test)
        return interactions.valid_pairs(sums.join(users, "userId", "left_semi"), "decayed_playtime")

    def playtime_stats(self) -> DataFrame:
        return self.pair_stats()[0]

    def test_stats(self) -> DataFrame:
        return self.pair_stats()[1]

    def labels(self) -> DataFrame:
        """The pairs are cut before they are ranked, which reads them several times."""
        return self._get("labels", lambda: scoring.confidence_labels(cut_lineage(self.playtime_stats())))

    def merged_train(self) -> DataFrame:
        def build():
            clicks = scoring.click_signals(self.click_windows()[0], decay=self.decay)
            return scoring.merge_signals(self.labels(), clicks, decay=self.decay)
        return self._get("merged_train", build)

    def merged_test(self) -> DataFrame:
        return self._get("merged_test", lambda: scoring.merged_test(
            self.test_stats(), self.click_windows()[1]))

    # ---- weights and filters
    def decayed_train(self) -> DataFrame:
        return self._get("decayed_train", lambda: cut_lineage(
            scoring.apply_decay(self.merged_train()) if self.decay else self.merged_train()))

    def popularity(self) -> DataFrame:
        return self._get("popularity", lambda: cut_lineage(
            scoring.item_popularity(self.decayed_train())))

    def weighted_train(self) -> DataFrame:
        return self._get("weighted_train", lambda: scoring.penalise_confidence(
            self.decayed_train(), self.popularity()) if self.penalize else self.decayed_train())

    def als_input(self) -> DataFrame:
        """Final train pairs, materialised once in the shared checkpoint folder
        (S9): the lookups, the encoded frames and the recommenders all read
        the files instead of recomputing the funnel."""
        return self._get("als_input", lambda: cut_lineage(scoring.active_users(
            self.weighted_train(), self.min_items)))

    # ---- ids
    def lookups(self) -> tuple[DataFrame, DataFrame]:
        return self._get("lookups", lambda: indexing.build_lookups(self.als_input()))

    def indexed(self) -> tuple[DataFrame, DataFrame]:
        def build():
            users, items = self.lookups()
            return indexing.encode(self.als_input(), self.merged_test(), users, items)
        return self._get("indexed", build)

    def ground_truth(self) -> DataFrame:
        return self._get("truth", lambda: indexing.ground_truth_rows(self.indexed()[1]))

    # ---- item-item rules and similarity recommendations
    def rule_rows(self) -> DataFrame:
        """The train window of all interactions."""
        from reelpath.sources.scan import day_window
        s = self.split
        return day_window(self.view("interactions"), s.base_date, s.test_days, s.test_days + s.train_days)

    def rule_baskets(self) -> DataFrame:
        """Items per (user, day) of those rows."""
        from reelpath.operators.search_rules import baskets
        return self._get("rule_baskets", lambda: baskets(self.rule_rows(), ["userId", "day"], "item_id"))

    def rule_model(self):
        from reelpath.operators.search_rules import fit_rules
        return self._get("rule_model", lambda: fit_rules(self.rule_baskets()))

    def sim_pairs(self) -> DataFrame:
        """Rules from one item to another; only pairs are counted."""
        from reelpath.operators.itemsets import basket_rows, mine, rules
        from reelpath.operators.search_rules import MIN_CONFIDENCE, MIN_SUPPORT

        def build():
            sets, n = mine(basket_rows(self.rule_rows(), ["userId", "day"], "item_id"), MIN_SUPPORT, max_size=2)
            r = rules(cut_lineage(sets), n, MIN_CONFIDENCE)
            return cut_lineage(r.select(F.element_at("antecedent", 1).alias("item_id"),
                                        F.element_at("consequent", 1).alias("rec_item_id"), "confidence", "lift", "support"))
        return self._get("sim_pairs", build)

    def sim_train(self, users: DataFrame | None = None) -> DataFrame:
        """The history that votes: of all users, or of those in ``users`` only."""
        return self.als_input() if users is None else self.als_input().join(users.select("userId"), "userId", "left_semi")

    def sim_indexed(self, drop_seen: bool = True, users: DataFrame | None = None) -> DataFrame:
        """Scores by id, dealt by user."""
        from reelpath.operators.recommend import similarity_scores, with_indexes
        train, pairs = with_indexes(self.sim_train(users), self.sim_pairs(), *self.lookups())
        return similarity_scores(train, cut_lineage(pairs), drop_seen, "userIndex", "itemIndex")

    def sim_top(self, k: int = 15, drop_seen: bool = True, users: DataFrame | None = None) -> DataFrame:
        """The ``k`` best of each user, cut: the metrics read them several times."""
        from reelpath.operators.recommend import top_k
        return cut_lineage(top_k(self.sim_indexed(drop_seen, users), k, score_col="total_score"))

    # ---- catalogue
    def metadata(self) -> DataFrame:
        from reelpath.operators.clean import catalogue_items
        return self._get("metadata", lambda: catalogue_items(
            self.view("catalogue_tv"), self.view("catalogue_movie")))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (results compared across engines)."""
    cols = [round_to(F.col(f.name), digits).alias(f.name)
            if f.dataType.typeName() in ("double", "float") else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)
