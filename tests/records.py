"""Records for tests."""

from siteweave.config import RECORD_SCHEMA

METRE = 1 / 111_320


def record(key="pge:1", south=0.0, **kw):
    provider, id_ = key.split(":", 1)
    base = dict(
        provider=provider, id=id_, key=key, name="Bald Hill", role="launch", lat=-33.7 - south * METRE, lon=151.3, wind={"N": 1, "NE": 2}, altitude=None,
        country="AU", url=None, closed=None, notes=None, tow=False, approximate_location=False, group_ids=[],
    )
    return base | kw


def frame(spark, rows):
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], RECORD_SCHEMA)
