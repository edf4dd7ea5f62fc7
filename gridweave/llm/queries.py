"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracles import ORACLE_SQL  # noqa: F401
from .op1_simhash import op1_simhash_near_dedup
from .op2_decontamination import op2_fm_decontamination
from .op3_packing import op3_min_bin_slack_packing
from .op4_token_files import op4_zstd_token_files
from .op5_toxicity import op5_clause_toxicity
from .op6_secrets import op6_trigram_secrets
from .op7_embedding_join import op7_epsilon_grid_join
from .op8_quality import op8_subword_quality
from .op9_url_filter import op9_template_url_filter
from .op10_token_counts import op10_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_fm_decontamination, op3_min_bin_slack_packing, op4_zstd_token_files, op5_clause_toxicity,
        op6_trigram_secrets, op7_epsilon_grid_join, op8_subword_quality, op9_template_url_filter, op10_token_counts,
    )
}
