"""Readers that turn payloads (GeoJSON, JSON, CSV, SQL, landed responses) into frames."""
