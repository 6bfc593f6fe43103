"""velolake: a Spark-native medallion pipeline for ride and scooter telemetry events.

Layers (all plain ``DataFrame -> DataFrame`` functions usable in batch and in
Structured Streaming):

* bronze  - message envelope -> ``raw_json`` + arrival time (:mod:`velolake.sources.envelope`)
* silver  - JSON parse, rule sets, valid / quarantine split (:mod:`velolake.operators.silver`)
* gold    - fact tables and dimensions (:mod:`velolake.operators.gold`)
* marts   - tumbling-window KPI tables (:mod:`velolake.operators.marts`)
* quality - reconciliation and data-quality report (:mod:`velolake.operators.quality`)
* reports - dashboard queries over the marts (:mod:`velolake.operators.reports`)

Streaming jobs, sinks and the on-disk lake layout live in :mod:`velolake.streaming`.
Named, oracle-checked queries over the driver tables live in :mod:`velolake.plans`.
"""

__version__ = "0.1.0"
