"""skyvane: sensor-telemetry analytics on Spark (see README)."""
