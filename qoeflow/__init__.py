"""Playback-quality analytics on Spark: telemetry -> KPIs -> session/device/account scores."""
