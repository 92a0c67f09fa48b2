"""Part of Tidewell."""
