"""quotelake: daily market quotes from a JSON lake to a star schema and its marts, on Spark."""
