"""The event stream: decode, alert, summarise, publish."""

from flotilla.streaming.pipeline import StreamPlan, build_plan, start_plan  # noqa: F401
