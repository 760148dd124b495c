"""Readers and writers: feeds, store tables, dated snapshots, media folders, patches."""
