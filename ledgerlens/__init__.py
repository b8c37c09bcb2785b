"""Spark-native analytics over UTXO-shaped ledgers."""
