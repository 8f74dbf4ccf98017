"""Preparing large text collections with Spark: reshape, filter, clean, tokenize, split, score."""

from grainsieve.functions.identity import document_id
from grainsieve.functions.text import parse_size
from grainsieve.operators.counting import (
    corpus_totals,
    rows_per_split,
    split_totals,
    token_report,
    tokens_per_shard,
    with_token_count,
)
from grainsieve.operators.holdout import holdout_per_shard, sample_by_token_budget
from grainsieve.operators.membership import (
    distinct_ids,
    document_ids,
    rows_in_list,
    rows_with_ids,
    rows_without_ids,
    split_by_ids,
)
from grainsieve.operators.reformat import reformat
from grainsieve.operators.scoring import (
    filter_quality,
    label_counts,
    recipe_quality,
    with_label_shares,
)
from grainsieve.operators.tokenizing import tokenize, tokenize_with_vocabulary
from grainsieve.plans.recipes import (
    KeywordLists,
    Recipe,
    Rule,
    apply_recipe,
    explain_rejections,
    recipe_for,
)

__all__ = [
    "KeywordLists",
    "Recipe",
    "Rule",
    "apply_recipe",
    "corpus_totals",
    "distinct_ids",
    "document_id",
    "document_ids",
    "explain_rejections",
    "filter_quality",
    "holdout_per_shard",
    "label_counts",
    "parse_size",
    "recipe_for",
    "recipe_quality",
    "reformat",
    "rows_in_list",
    "rows_per_split",
    "rows_with_ids",
    "rows_without_ids",
    "sample_by_token_budget",
    "split_by_ids",
    "split_totals",
    "token_report",
    "tokenize",
    "tokenize_with_vocabulary",
    "tokens_per_shard",
    "with_label_shares",
    "with_token_count",
]
