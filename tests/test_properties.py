"""Column functions against plain Python on generated text."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import text

CONTROL = "".join(chr(c) for c in range(33))
ANY_TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=30)
DELIMITED = st.text(st.sampled_from(",|; \t\\.*abé"), max_size=20)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(ANY_TEXT, DELIMITED), min_size=1, max_size=50), st.sampled_from([",", "|", ";", "\\", ".", "*", "||", "\n"]))
def test_text_functions(spark, values, separator):
    value = F.col("v")
    rows = (
        spark.createDataFrame([(v,) for v in values], "v string")
        .select(
            "v",
            text.trim_control(value).alias("trimmed"),
            text.tokens(value, separator).alias("tokens"),
            text.strip_special(value).alias("plain"),
            text.protocol_of(value).alias("protocol"),
        )
        .collect()
    )
    for row in rows:
        assert row.trimmed == row.v.strip(CONTROL)
        assert row.tokens == row.v.split(separator)
        assert row.plain == re.sub("[^A-Za-z0-9 ]", "", row.v)
        assert row.protocol == "noprotocol"
