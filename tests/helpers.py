import datetime as dt

from tripwright import schemas


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def stage_df(spark, rows):
    """rows: (region, origin, destination, 'yyyy-mm-dd hh:mm:ss' | None, datasource)."""
    data = [(r, o, d, ts(t) if t else None, s) for r, o, d, t, s in rows]
    return spark.createDataFrame(data, schemas.TRIPS)


def write_csv(path, rows, header=True):
    with open(path, "w") as f:
        if header:
            f.write("region,origin_coord,destination_coord,datetime,datasource\n")
        for r in rows:
            f.write(",".join(r) + "\n")
