"""ordermill: batch analytics for order-to-delivery marketplaces, written as Spark DataFrame jobs."""
