"""slotbook: ad-log report engine on Spark."""
