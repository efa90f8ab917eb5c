"""DataFrame-to-DataFrame operators. All are narrow and run the same on a stream and on a table."""
