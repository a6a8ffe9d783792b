"""petrichor: daily weather observations, rain labels and rain forecasts on Spark."""
