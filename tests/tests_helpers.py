from datetime import datetime

from marketlake.schemas import BRONZE_COLUMNS

SCHEMA = ("stream_kind string, payload string, exchange string, symbol string, event_ts_ms bigint, "
          "ingest_ts string, kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_ts timestamp, "
          "dt string")


def bronze_rows(spark, n=50):
    rows = [("trades", f'{{"trade_id": "{i % 10}", "event_ts_ms": {1704067200000 + i}, "price": "1", '
                       f'"quantity": "1", "is_buyer_maker": "true"}}', "x", "S", None, f"i{i}", "raw.trades.v1",
             i % 3, i, datetime(2024, 1, 1), "2024-01-01") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).select(*BRONZE_COLUMNS)
