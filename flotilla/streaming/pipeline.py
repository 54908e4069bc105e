"""Stream plan over topic records.

records ─ decode ─┬─ event feed (append)
                  ├─ alerts (one pass over the rule table) ─┬─ alert feed (append)
                  │                                         └─ alerts per 2 min × vehicle × kind
                  ├─ events per 1 min × kind (+ distinct vehicles)
                  └─ events per day × kind (kept current, for the dashboard)

Summaries window on **event time** (the record timestamp) with a watermark and are published
in append mode: a window is written once, when the watermark passes its end, and its state
is dropped then. A "latest" view of open windows, in update mode, is optional.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flotilla import schemas as S
from flotilla.operators.events import alerts as alert_rules
from flotilla.operators.events import decode_records
from flotilla.operators.windows import (
    DAILY_KEYS, LATEST_KEYS, alerts_by_vehicle, daily_counts, event_time, events_by_type, flatten_window, roll_up_latest,
    vehicle_counts,
)
from flotilla.sinks.stream import append_feed, print_rows, shared_feed, upsert_table
from flotilla.streaming.quality import BAD_PAYLOAD, observed


@dataclass
class StreamPlan:
    events: DataFrame
    alerts: DataFrame
    events_by_type: DataFrame
    alerts_by_vehicle: DataFrame
    events_by_type_latest: DataFrame
    daily_counts: DataFrame


def build_plan(records: DataFrame, processed_at=True, alert_time: str = "kafka_timestamp") -> StreamPlan:
    """All stream outputs as lazy streaming DataFrames over one record source.

    Alert windows advance with the whole stream's event time: the watermark sits on the decoded
    events and the alert rules (a generator, no filter that could be pushed below it) come
    after, so windows close even when alerts are rare. ``alert_time="procesado_en"`` windows
    alerts on processing time instead (results then depend on when the job runs).
    """
    ev = observed(decode_records(records, bad_column=BAD_PAYLOAD))
    al = alert_rules(ev, processed_at=processed_at)
    if alert_time == "kafka_timestamp":
        timed = event_time(ev, alert_time).withWatermark(alert_time, S.ALERT_WATERMARK)
        per_vehicle = alerts_by_vehicle(alert_rules(timed, processed_at=processed_at), ts=alert_time,
                                        processed_at=processed_at)
    else:
        per_vehicle = alerts_by_vehicle(al, ts=alert_time, watermark=S.ALERT_WATERMARK, processed_at=processed_at)
    return StreamPlan(
        events=ev,
        alerts=al,
        events_by_type=events_by_type(decode_records(records, ["tipo_evento"]), watermark=S.EVENT_WATERMARK,
                                      distinct="chained", processed_at=processed_at),
        alerts_by_vehicle=per_vehicle,
        events_by_type_latest=flatten_window(vehicle_counts(decode_records(records, ["tipo_evento"]),
                                                            watermark=S.EVENT_WATERMARK)),
        daily_counts=daily_counts(decode_records(records, ["tipo_evento"])),
    )


def start_plan(plan: StreamPlan, out_root: str, checkpoint_root: str,
               feed_trigger: str | None = "10 seconds", summary_trigger: str | None = "30 seconds",
               latest: bool = False, console: bool = False, prefix: str = "flota",
               shared_feeds: bool = False, processed_at=True, daily: bool = False) -> list[StreamingQuery]:
    """Start every sink as its own named query with its own checkpoint.

    ``daily`` keeps ``eventos_por_dia``, events per day and kind, from which the dashboard takes its
    event series without reading the feed.
    ``latest`` adds a summary of open windows, too, brought up to date by each micro-batch: its
    stateful step keeps one row per (window, kind, vehicle) until the watermark passes the
    window, batches write the rows they changed, by day, and ``read_latest`` with
    ``roll_up_latest`` gives (window, kind); days that the watermark has passed are sealed. ``console`` prints its newest rows after each batch. ``shared_feeds``
    writes the event and alert feeds from one query (one scan and decode per micro-batch,
    idempotent per-batch folders) instead of two file-sink queries; locally it measured no
    faster, so it is opt-in for streams where decoding dominates.
    """
    def paths(name):
        return f"{out_root}/{name}", f"{checkpoint_root}/{prefix}_{name}"

    qs = []
    if shared_feeds:
        # One query feeds both stateless tables: each micro-batch is decoded once, kept for
        # the two writes, and written per batch id (a retried batch overwrites its own folders).
        ev_out, _ = paths("eventos_streaming")
        al_out, _ = paths("alertas_streaming")
        qs.append(shared_feed(plan.events, f"{prefix}_feeds", ev_out, al_out,
                              f"{checkpoint_root}/{prefix}_feeds", feed_trigger, processed_at))
    else:
        # The raw event feed grows with the stream: partition it by event day so readers prune.
        daily = plan.events.withColumn("dia", F.to_date("kafka_timestamp"))
        out, ck = paths("eventos_streaming")
        qs.append(append_feed(daily, f"{prefix}_eventos_streaming", out, ck, feed_trigger,
                              partition_by=["dia"]))
        out, ck = paths("alertas_streaming")
        qs.append(append_feed(plan.alerts, f"{prefix}_alertas_streaming", out, ck, feed_trigger))
    for name, df, trig in [("resumen_eventos", plan.events_by_type, summary_trigger),
                           ("resumen_alertas", plan.alerts_by_vehicle, summary_trigger)]:
        out, ck = paths(name)
        qs.append(append_feed(df, f"{prefix}_{name}", out, ck, trig))
    if daily:
        out, ck = paths("eventos_por_dia")
        qs.append(upsert_table(plan.daily_counts, f"{prefix}_eventos_por_dia", out, ck, DAILY_KEYS, summary_trigger, day_of="fecha"))
    if latest or console:
        out, ck = paths("resumen_eventos_actual")
        name = f"{prefix}_resumen_eventos_actual"
        newest = [F.desc("ventana_inicio"), F.asc("tipo_evento")]
        watch = (lambda t, n: print_rows(roll_up_latest(t), name, n, order=newest)) if console else None
        qs.append(upsert_table(plan.events_by_type_latest, name, out, ck, LATEST_KEYS, summary_trigger, watch=watch,
                               day_of="ventana_inicio", delay=S.EVENT_WATERMARK))
    return qs
