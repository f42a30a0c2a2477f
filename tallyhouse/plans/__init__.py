"""Named jobs: transaction metrics, fraud windows, text, ratings, incidents, pipelines."""
