from encore.operators import activity, joins, sampling
from encore.plans import catalog, roles
from encore.streaming import cleaned_activity_stream, read_interaction_stream, start_activity_query
from tests.conftest import SF_SMALL


def test_stream_matches_batch(spark, tmp_dir):
    base = roles.base_interactions(spark, SF_SMALL)
    src = f"{tmp_dir}/in"
    # Two arrivals that together hold every row.
    first, second = sampling.hash_split(base, ["user_id"], [0.5, 0.5])
    first.write.parquet(f"{src}/a")
    blocked = catalog._blocklist(spark, SF_SMALL)
    collected = []

    def sink(batch, _):
        collected.append({r["user_id"]: (r["song_count"], r["play_count"]) for r in batch.collect()})

    stream = read_interaction_stream(spark, f"{src}/*", base.schema)
    q = start_activity_query(cleaned_activity_stream(stream, blocked), sink, f"{tmp_dir}/ckpt")
    q.processAllAvailable()
    second.write.parquet(f"{src}/b")
    q.processAllAvailable()
    q.stop()

    latest = {}
    for batch in collected:
        latest.update(batch)
    batch_result = activity.user_activity(joins.exclude(base, blocked, "song_id")).collect()
    assert latest == {r["user_id"]: (r["song_count"], r["play_count"]) for r in batch_result}
