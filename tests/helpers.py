"""Tiny hand-made snapshots for the mart tests."""
from __future__ import annotations

from staylens import schemas
from staylens.plans import star

FIELDS = [n for n, _ in schemas.SNAPSHOT_FIELDS]


def snap_row(listing_id, month, nb="A", price=100, active="t", avail=10, rating=90.0,
             host="h1", superhost="f", host_nb="A", ptype="House", rtype="Entire", acc=2,
             day="01"):
    row = dict.fromkeys(FIELDS)
    row.update(listing_id=listing_id, scrape_id=1, scraped_date=f"{month}-{day}", host_id=1,
               host_name=host, host_since="2015-01-01", host_is_superhost=superhost,
               host_neighbourhood=host_nb, listing_neighbourhood=nb, property_type=ptype,
               room_type=rtype, accommodates=acc, price=price, has_availability=active,
               availability_30=avail, number_of_reviews=1, review_scores_rating=rating)
    return row


def snapshot_df(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], schemas.SNAPSHOT_SCHEMA)


def dims(spark, rows):
    s = snapshot_df(spark, rows)
    return star.listing_dim(s), star.host_dim(s)


def rows_of(df):
    """Rows as dictionaries, of a DataFrame or of the brute-force marts."""
    return df if isinstance(df, list) else [r.asDict() for r in df.collect()]
