"""Replay properties: any batch split = the whole; replays change nothing;
dimension ids never change once assigned."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripwright import schemas
from tripwright.operators.dims import upsert_dim
from tripwright.operators.facts import build_delta, insert_if_absent
from helpers import stage_df

REGIONS = ["Vienna", "Lisbon", "Bergen", "Oslo", "Lyon"]

trip = st.tuples(
    st.sampled_from(REGIONS),
    st.integers(0, 3),             # origin x
    st.integers(0, 3),             # destination x
    st.integers(1, 28),            # day of May 2018
    st.sampled_from(["a", "b"]),   # datasource
)


def to_rows(trips):
    return [(r, f"POINT ({o} 1)", f"POINT ({d} 2)", f"2018-05-{day:02d} 10:00:00", s)
            for r, o, d, day, s in trips]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck),
          database=None)
@given(st.lists(trip, min_size=1, max_size=25), st.lists(st.integers(0, 3), min_size=1, max_size=2))
def test_batches_fold_to_distinct_whole(spark, trips, order):
    rows = to_rows(trips)
    # overlapping batches: batch k holds rows whose index % 4 != k
    batches = [[x for i, x in enumerate(rows) if i % 4 != k] or rows[:1] for k in range(4)]
    region = spark.createDataFrame([], schemas.DIM_REGION)
    source = spark.createDataFrame([], schemas.DIM_DATASOURCE)
    ids = {}
    fact = spark.createDataFrame([], schemas.FACT_DELTA)
    for k in order + [3, 1, 0, 2]:
        s = stage_df(spark, batches[k])
        region = region.unionByName(upsert_dim(s, region, "region", "region_id")).checkpoint()
        source = source.unionByName(upsert_dim(s, source, "datasource", "datasource_id")).checkpoint()
        now = {r.region: r.region_id for r in region.collect()}
        assert all(now[k2] == v for k2, v in ids.items())          # ids never change
        assert sorted(now.values()) == list(range(1, len(now) + 1))  # dense
        ids = now
        fact = fact.unionByName(insert_if_absent(build_delta(s, region, source), fact)).checkpoint()
    whole = build_delta(stage_df(spark, rows), region, source)

    def rowset(df):
        return sorted((r.event_timestamp, bytes(r.event_id), r.region_id, r.datasource_id,
                       tuple(r.origin_coord), tuple(r.destination_coord)) for r in df.collect())

    got, want = rowset(fact), rowset(whole)
    assert got == want and len(set(got)) == len(got)
