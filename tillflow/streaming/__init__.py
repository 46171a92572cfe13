"""Jobs over streams: sinks, the point-of-sale flow, the customer flow."""
