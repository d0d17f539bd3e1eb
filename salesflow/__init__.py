"""salesflow: batch, speed and serving views over a stream and history of sales records."""
