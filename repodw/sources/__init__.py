"""Raw files in, warehouse tables in and out, exports."""
