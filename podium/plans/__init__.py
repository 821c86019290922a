from podium.plans.enrichment import (
    consume_epochs,
    consume_topic,
    enrich_epochs,
    enrich_stream,
    last_epoch,
    publish_table,
)
from podium.plans.ledger import record_medal_count, record_medal_count_jdbc
from podium.plans.medallion import (
    bronze_to_silver,
    landing_to_bronze,
    run_medallion,
    silver_to_gold,
)

__all__ = [
    "bronze_to_silver",
    "consume_epochs",
    "consume_topic",
    "enrich_epochs",
    "enrich_stream",
    "landing_to_bronze",
    "last_epoch",
    "publish_table",
    "record_medal_count",
    "record_medal_count_jdbc",
    "run_medallion",
    "silver_to_gold",
]
