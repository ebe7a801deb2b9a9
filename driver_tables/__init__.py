"""The star-schema tables standing in for the feeds, and the queries over them."""
