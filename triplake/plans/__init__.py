"""Job plans: table sinks, the end-to-end pipeline run and plan inspection."""
