"""SQL-language functions agree with the Column functions (same golden values)."""
import datetime as dt

from pyspark.sql import functions as F

from adherence.functions import geo, sql
from adherence.functions import gtfs_time as T


def test_sql_functions(spark):
    assert set(sql.register(spark)) >= {"gtfs_seconds", "rt_start_epoch", "haversine_km"}
    assert spark.sql("SELECT gtfs_seconds('999999999:00:00')").first()[0] is None
    r = spark.sql("""SELECT gtfs_seconds('25:30:00') s, gtfs_seconds('8:15') bad,
                            gtfs_local_datetime(DATE'2026-07-11', '25:30:00') t,
                            rt_start_epoch('20260329', '02:30:00', 'Europe/Stockholm') gap,
                            rt_start_epoch('20260712', '1783864440', 'Europe/Stockholm') bare,
                            date_key(DATE'2026-07-11') k,
                            haversine_km(59.33, 18.06, 59.34, 18.06) km""").first()
    assert (r.s, r.bad, r.t, r.gap, r.bare, r.k) == (91800, None, dt.datetime(2026, 7, 12, 1, 30), 1774747800,
                                                     1783864440, 20260711)
    col = spark.range(1).select(geo.haversine_km(F.lit(59.33), F.lit(18.06), F.lit(59.34), F.lit(18.06))).first()[0]
    assert abs(r.km - col) < 1e-12
    e = spark.range(1).select(T.rt_start_to_epoch(F.lit("20261025"), F.lit("02:30:00"))).first()[0]
    assert spark.sql("SELECT rt_start_epoch('20261025', '02:30:00', 'Europe/Stockholm')").first()[0] == e
