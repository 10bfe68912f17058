"""Job settings: built-in defaults, a properties file, then the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

# Setting names and their defaults.
DEFAULTS: dict[str, str] = {
    "pg.host": "localhost",
    "pg.port": "5432",
    "pg.database": "pipeline",
    "pg.username": "pipeline",
    "pg.password": "pipeline",
    "pg.schema.list": "public",
    "pg.table.list": "public.products",
    "kafka.bootstrap.servers": "localhost:9092",
    "kafka.topic.prices": "prices",
    "kafka.topic.stock": "stock",
    "kafka.topic.dlq": "dlq",
    "kafka.group.id": "docweave",
    "es.host": "localhost",
    "es.port": "9200",
    "es.index.name": "products",
    "checkpoint.interval.ms": "60000",
    "state.ttl.hours": "24",
    "es.bulk.flush.max.actions": "500",
    "es.bulk.flush.interval.ms": "1000",
}


@dataclass(frozen=True)
class Settings:
    values: Mapping[str, str]

    def text(self, name: str) -> str:
        return self.values[name]

    def number(self, name: str) -> int:
        return int(self.values[name])

    @property
    def ttl_ms(self) -> int:
        return self.number("state.ttl.hours") * 3_600_000

    @property
    def trigger(self) -> dict[str, str]:
        """Micro-batch trigger that stands for the sink's flush interval."""
        return {"processingTime": f"{self.number('es.bulk.flush.interval.ms')} milliseconds"}

    def kafka_options(self, topic_setting: str, starting: str = "latest") -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.text("kafka.bootstrap.servers"),
            "subscribe": self.text(topic_setting),
            "groupIdPrefix": self.text("kafka.group.id"),
            "startingOffsets": starting,
        }

    def jdbc_options(self) -> dict[str, str]:
        return {
            "url": f"jdbc:postgresql://{self.text('pg.host')}:{self.number('pg.port')}/{self.text('pg.database')}"
            f"?currentSchema={self.text('pg.schema.list')}",
            "user": self.text("pg.username"),
            "password": self.text("pg.password"),
            "dbtable": self.text("pg.table.list"),
        }

    def rejects_options(self) -> dict[str, str]:
        """Where a Kafka sink puts rejected messages."""
        return {"kafka.bootstrap.servers": self.text("kafka.bootstrap.servers"), "topic": self.text("kafka.topic.dlq")}

    def index_options(self) -> dict[str, str]:
        """A search index as a sink of documents, by the options of its Spark connector."""
        return {
            "es.nodes": self.text("es.host"),
            "es.port": self.text("es.port"),
            "es.resource": self.text("es.index.name"),
            "es.mapping.id": "product_id",
            "es.write.operation": "upsert",
            "es.batch.size.entries": self.text("es.bulk.flush.max.actions"),
        }

    @property
    def state_options(self) -> dict[str, str]:
        """Session settings: each batch stores its changes of state, whole snapshots follow at the checkpoint interval."""
        return {
            "spark.sql.streaming.stateStore.maintenanceInterval": f"{self.number('checkpoint.interval.ms')}ms",
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        }


def _read_properties(path: str) -> dict[str, str]:
    found: dict[str, str] = {}
    with open(path, encoding="utf-8") as lines:
        for line in lines:
            line = line.strip()
            if line and line[0] not in "#!" and "=" in line:
                name, value = line.split("=", 1)
                found[name.strip()] = value.strip()
    return found


def load_settings(path: str | None = None, env: Mapping[str, str] | None = None) -> Settings:
    """Defaults, overridden by the file, overridden by ``A_B`` style variables."""
    env = os.environ if env is None else env
    values = dict(DEFAULTS)
    if path is not None:
        values.update(_read_properties(path))
    values.update({name.lower().replace("_", "."): value for name, value in env.items()})
    return Settings(values)
