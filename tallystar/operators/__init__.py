from tallystar.operators.aggregate import (
    Link,
    conditional_count,
    count_pairs,
    distinct_rows,
    keep_groups,
    match_groups,
    roll_up,
)
from tallystar.operators.history import join_as_of, with_versions
from tallystar.operators.joins import anti_join, anti_join_sql, lookup, missing_members, semi_join
from tallystar.operators.ranking import Arm, best_per_arm, rank_all, ranked_with_ties, top_k
from tallystar.operators.setops import union_all, union_distinct
from tallystar.operators.skew import Salted, salt_pair, salted_join

__all__ = [
    "Arm",
    "Link",
    "Salted",
    "anti_join",
    "anti_join_sql",
    "best_per_arm",
    "conditional_count",
    "count_pairs",
    "distinct_rows",
    "join_as_of",
    "keep_groups",
    "lookup",
    "match_groups",
    "missing_members",
    "rank_all",
    "ranked_with_ties",
    "roll_up",
    "salt_pair",
    "salted_join",
    "semi_join",
    "top_k",
    "union_all",
    "union_distinct",
    "with_versions",
]
