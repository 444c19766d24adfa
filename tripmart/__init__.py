"""tripmart — monthly trip records to a star schema, as Spark jobs.

Typical use::

    from tripmart import build_session, read_raw, transform, write_zone
    spark = build_session()
    fact = transform(read_raw(spark, "s3://…/raw", months=[(2023, 1)]))
    write_zone(fact, "s3://…/fact")            # overwrites only 2023-01

Operators are DataFrame -> DataFrame functions; see README.md.
"""

from .operators.clean import clean, range_rules, required_not_null, rule_violations
from .operators.conform import (apply_mapping, conform, drop_by_pattern, drop_null_columns,
                                fact_mapping, load_mapping, null_column_report, rename)
from .operators.dims import (dim_dates, dim_payment_types, dim_rate_codes, dim_times,
                             dim_vendors, star_dims)
from .operators.discover import (audit, filter_links, links, new_sources, unprocessed,
                                 with_partition_key, with_period)
from .operators.insights import (avg_total_by_passengers, borough_pairs_topk,
                                 demand_heatmap, demand_peak, passenger_premium,
                                 payment_share)
from .operators.keys import with_trip_id
from .operators.marts import trips_datetime, trips_labelled
from .operators.quality import fk_orphans, pk_report, pk_violations
from .plans.run import load_pending, run_pending
from .plans.star import create_star_schema, load_star
from .plans.transform import stages, transform
from .session import build_session
from .sources.raw import list_partitions, normalise, read_raw
from .sources.zones import (read_seed_csv, read_text_zone, recompress, register_zone_table,
                            write_text_zone, write_zone)
from .streaming.incremental import run_incremental, run_load_incremental

__all__ = sorted(n for n, v in list(globals().items())
                 if not n.startswith("_") and callable(v))
