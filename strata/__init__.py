"""strata: clickstream and transaction analytics as Spark DataFrame operators.

Every public operator takes DataFrames and returns a lazy DataFrame built from
the public Spark API; the caller decides when and how to act on it.

Where things are, by the job they serve:

* memory (sessions -> profiles -> ranked users):
  ``operators.rollups.session_rollup / user_profiles``,
  ``operators.ranking.top_k_ranked / global_row_number / global_percent_rank``,
  ``operators.rollups.ltv_distribution``
* shuffle (user stats, buckets, enriched sessions):
  ``operators.rollups.user_stats / revenue_buckets / enriched_sessions``
* partitions (sizes and files): ``operators.layout.size_partitions /
  write_compacted / file_layout_report / partition_row_counts /
  compact_folder / estimate_written / size_result_partitions``
* broadcast (dimension joins): ``operators.joins.left_join_broadcast /
  left_join_shuffle / bucketed_join``, ``operators.rollups.tier_stats``
* skew: ``operators.skew.skew_report / key_frequency_top / salted_user_stats /
  hot_key_split_union``, ``operators.joins.hot_keys / hot_key_join / salted_join``
* skew, from measured keys: ``operators.heavy.heavy_hitters``,
  ``operators.partitioner.measure / repartition_by_weight``
* caching and loops: ``operators.iterate.iterate / reused / components / rank_rounds``
* states that merge: ``operators.moments``, ``operators.quantiles``, ``operators.states``
* sources: ``sources.tables`` (driver tables, clickstream view, user
  dimension), ``sources.generators`` (seeded generators, size presets)
* run metrics: ``sources.eventlog.read_event_log``, ``operators.runlog``
* the five jobs end to end, plain or tuned: ``plans.scenarios``; command line:
  ``python -m strata.cli``
"""

__version__ = "0.1.0"
