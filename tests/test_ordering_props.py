"""Property tests for the distributed running sums and exact quantiles:
random groups (with nulls and a dominant group), random partition counts,
checked against pandas / numpy on the same rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ratelake.operators.ordering import global_position, prefix_sums
from ratelake.operators.profile import exact_quantiles

_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["a", "b", "hot", "hot", "hot"])),
        st.integers(min_value=0, max_value=40),
        st.integers(min_value=1, max_value=5),
    ),
    min_size=1,
    max_size=120,
)

_settings = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@_settings
@given(rows=_rows, parts=st.integers(min_value=1, max_value=9))
def test_prefix_sums_equal_pandas(spark, rows, parts):
    pdf = pd.DataFrame(rows, columns=["g", "v", "w"]).groupby(["g", "v"], dropna=False, as_index=False)["w"].sum()
    df = spark.createDataFrame(
        [(None if pd.isna(g) else g, int(v), int(w)) for g, v, w in pdf.itertuples(index=False)],
        "g string, v long, w long",
    )
    got = prefix_sums(df, ["v"], "w", ["g"], num_partitions=parts).toPandas()
    want = pdf.sort_values(["g", "v"], na_position="first").copy()
    want["cum"] = want.groupby("g", dropna=False)["w"].cumsum()
    m = got.merge(want, on=["g", "v", "w"], how="outer", indicator=True)
    assert (m["_merge"] == "both").all()
    assert (m["_cum"] == m["cum"]).all()


@_settings
@given(keys=st.sets(st.integers(min_value=-10_000, max_value=10_000), min_size=1, max_size=150),
       parts=st.integers(min_value=1, max_value=9))
def test_global_position_is_rank(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = global_position(df, ["k"], num_partitions=parts).toPandas().sort_values("k")
    assert got["_pos"].tolist() == list(range(len(keys)))


@_settings
@given(rows=_rows, probs=st.lists(st.floats(min_value=0, max_value=1), min_size=1, max_size=4))
def test_exact_quantiles_equal_numpy(spark, rows, probs):
    df = spark.createDataFrame([(g, float(v)) for g, v, _ in rows], "g string, v double")
    got = exact_quantiles(df, "v", probs, ["g"]).toPandas()
    pdf = pd.DataFrame([(g, float(v)) for g, v, _ in rows], columns=["g", "v"])
    for g, grp in pdf.groupby("g", dropna=False):
        key = None if pd.isna(g) else g
        row = got[got["g"].isna()] if key is None else got[got["g"] == key]
        assert len(row) == 1
        want = np.quantile(grp["v"].to_numpy(), probs, method="linear")
        assert np.allclose(row.iloc[0, 1:].to_numpy(dtype=float), want, atol=1e-9)


_countries = st.lists(
    st.one_of(
        st.sampled_from(["", " ", "ES", "a/b", "k=v", "100%", "Côte d'Ivoire", "日本", "x y"]),
        st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc")), max_size=6),
    ),
    min_size=1,
    max_size=12,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(countries=_countries)
def test_lake_roundtrip_any_country_text(spark, countries):
    from ratelake.contract import CONTRACT_SCHEMA
    from ratelake.session import shared_path
    from ratelake.sources.lake import read_lake, write_batch

    rows = [
        tuple({"restaurant_name": f"r{i}", "country": c}.get(f.name) for f in CONTRACT_SCHEMA.fields)
        for i, c in enumerate(countries)
    ]
    df = spark.createDataFrame(rows, CONTRACT_SCHEMA)
    root = shared_path(spark, "lake_prop")
    write_batch(df, root, 7)
    got = sorted((r.restaurant_name, r.country) for r in read_lake(spark, root).collect())
    assert got == sorted((f"r{i}", c) for i, c in enumerate(countries))
