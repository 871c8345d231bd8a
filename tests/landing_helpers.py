"""Hand-made landing rows shared by the warehouse tests."""

import datetime as dt

SF = "/root/testdata/sf0.001"
LOADED = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def landing_rows(spark, rows):
    """rows: dicts with any landing columns; missing → defaults / NULL."""
    from farebox.schemas import LANDING_SCHEMA
    out = []
    for i, r in enumerate(rows):
        base = {"source_kind": "demo", "source_file_id": 1, "source_filename": "f",
                "source_row_number": i + 1, "service_type": "yellow", "pickup_datetime": None,
                "dropoff_datetime": None, "pickup_location_id": None, "dropoff_location_id": None,
                "trip_distance": None, "total_amount": None, "dispatching_base_num": None,
                "hvfhs_license_num": None, "loaded_at": LOADED}
        base.update(r)
        out.append(tuple(base[f.name] for f in LANDING_SCHEMA.fields))
    return spark.createDataFrame(out, LANDING_SCHEMA)


def ts(s):
    return dt.datetime.fromisoformat(s)
