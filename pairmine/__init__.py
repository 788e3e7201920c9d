"""Image/description pair mining on Spark."""
