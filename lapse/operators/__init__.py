"""Distributed building blocks: latest-per-group, interval join, band self-join,
bucketed prefix counts (rank, floor-index quantiles), chunked lag, exact order statistics,
grid joins that cut hot keys, similarity join on edit distance."""

from .edit_join import similar_texts
from .grid import grid_join
from .interval_join import interval_join
from .lag import chunked_lag
from .latest import earliest_per, latest_per
from .order_stats import exact_quantile, grouped_quantiles, quantile
from .pairs import band_self_pairs
from .prefix import prefix_counts
from .quantiles import floor_index_quantiles
from .rank import rank_desc

__all__ = ["chunked_lag", "prefix_counts", "interval_join", "earliest_per", "latest_per", "exact_quantile", "grouped_quantiles", "quantile",
           "band_self_pairs",
           "grid_join", "similar_texts", "floor_index_quantiles", "rank_desc"]
