"""Message-feed processing on Spark: route, parse, validate, divert, re-encode and publish JSON records."""
