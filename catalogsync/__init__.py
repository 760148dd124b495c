"""Reconcile supplier catalogue feeds with a store catalogue, as Spark jobs."""
