"""Session helpers."""

from tripmart.session import PIPELINE_CONF


def test_pipeline_conf_applied(spark):
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode",
              "spark.sql.codegen.hugeMethodLimit"):
        assert spark.conf.get(k) == PIPELINE_CONF[k]
