"""Network-threat analytics on Spark: DataFrame operators for firewall and security logs."""

__version__ = "0.1.0"
