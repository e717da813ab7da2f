"""DataFrame -> DataFrame operators.

``rollups`` (sessions, users, buckets, tiers), ``ranking`` (distributed ranks
and top-k), ``joins`` (checked broadcasts, salting, hot keys, buckets),
``skew`` (detection, exact salted aggregates), ``heavy`` (frequent keys),
``partitioner`` (partitions from weights), ``iterate`` (loops), ``moments``,
``quantiles`` and ``states`` (what merges), ``layout`` (sinks, file sizes,
compaction, sorts), ``runlog`` (run metrics from event logs).
"""

from strata.operators import (heavy, iterate, joins, layout, moments, partitioner, quantiles, ranking,  # noqa: F401
                              rollups, runlog, skew, states)
