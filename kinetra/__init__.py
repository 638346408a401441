"""Spark jobs that turn raw accelerometer and gyroscope recordings into uniform training segments."""
