"""Column helpers and the fixed values the forecast is built on."""
