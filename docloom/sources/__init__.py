"""Where records come from and go to: pages, intermediate JSON, CSV and JSON-lines output."""
