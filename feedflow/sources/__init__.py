"""Message sources. All return the Kafka envelope, bounded or streaming."""
